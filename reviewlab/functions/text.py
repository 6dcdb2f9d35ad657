"""Text cleaning, normalising and measuring as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The code points Python's str.isspace and \s accept. Java's \s is
# ASCII only, so the set is written out wherever whitespace matters.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)

# Four invisible characters become a space, the soft hyphen goes.
INVISIBLE_TO_SPACE = "\u200b\u200c\u200d\ufeff"
DROPPED = "\u00ad"

# Fixed value: URLs, in text whose only whitespace is the space.
URL = r"https?://[^ ]+|www\.[^ ]+"

# Phrases that mark a question besides the question mark.
QUESTION_PHRASES = [
    "does this",
    "is this",
    "can i",
    "will it",
    "how do i",
    "do these",
    "would this",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` alone knows spaces)."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def spaced(c: Column | str, also: str = "", drop: str = "") -> Column:
    """Every whitespace character, and those in ``also``, as a plain space."""
    old = WHITESPACE.replace(" ", "") + also
    return F.translate(_col(c), old + drop, " " * len(old))


def _collapse(c: Column) -> Column:
    # Single spaces are left alone, so the expression rarely has anything to copy.
    return F.trim(F.regexp_replace(c, " {2,}", " "))


def squeeze(c: Column | str) -> Column:
    """Whitespace runs become one space; ends are stripped."""
    return _collapse(spaced(c))


def split_words(c: Column | str) -> Column:
    """Whitespace-separated words."""
    return F.array_remove(F.split(spaced(c), " "), "")


def build_text(df: DataFrame, cols: tuple[str, ...] = ("summary", "reviewText")) -> Column:
    """Join the text columns by a space; null or absent columns count as empty."""
    parts = [
        F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
        for c in cols
    ]
    return strip(F.concat_ws(" ", *parts))


def _visible_lower(c: Column | str) -> Column:
    """Plain spaces only, no invisible characters, no URLs, lower case."""
    plain = spaced(c, INVISIBLE_TO_SPACE, DROPPED)
    return F.lower(F.regexp_replace(plain, URL, ""))


def clean_text(c: Column | str) -> Column:
    """Drop invisible characters and URLs, lower-case, squeeze whitespace.

    URLs go before lower-casing, so an upper-case scheme is kept as a word.
    """
    return _collapse(_visible_lower(c))


def normalize_ws(c: Column | str) -> Column:
    """Key for duplicate detection: null as empty, lower case, squeezed."""
    return squeeze(F.lower(F.coalesce(_col(c).cast("string"), F.lit(""))))


def normalize_tokens(c: Column | str) -> Column:
    """Cleaned text reduced to ``[a-z0-9 ]``; everything else separates words."""
    return F.trim(F.regexp_replace(_visible_lower(c), "[^a-z0-9]+", " "))


def has_tokens(c: Column | str) -> Column:
    """Whether ``normalize_tokens`` leaves anything, mostly without computing it.

    A text that cannot contain a URL, even after soft hyphens are removed, keeps its
    letters and digits; the two non-ASCII letters listed become ASCII in lower case.
    """
    c = _col(c)
    suspect = (
        F.contains(c, F.lit("http")) | F.contains(c, F.lit("www.")) | F.contains(c, F.lit(DROPPED))
    )
    return F.when(suspect, F.length(normalize_tokens(c)) > 0).otherwise(
        c.rlike(r"[A-Za-z0-9\u0130\u212a]")
    )


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words; null counts as none."""
    return F.size(split_words(F.coalesce(_col(c), F.lit(""))))


def char_count(c: Column | str) -> Column:
    """Number of code points; null counts as none."""
    return F.length(F.coalesce(_col(c), F.lit("")))


def text_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumns({"word_len": word_count(text), "char_len": char_count(text)})


def text_digest(c: Column | str) -> Column:
    """256-bit digest standing in for a text as a grouping key: shuffles carry 64
    characters per distinct text instead of the text."""
    return F.sha2(_col(c).cast("string"), 256)


def is_question(c: Column | str, min_len: int = 5) -> Column:
    """A question mark or a question phrase on word boundaries, and more than
    ``min_len`` characters once stripped. Null is not a question."""
    # Word boundaries spelled out: an engine's own idea of a word character
    # need not include accented letters.
    letter = r"\p{L}\p{N}_"
    phrases = "|".join(QUESTION_PHRASES)
    pattern = rf"\?|(^|[^{letter}])({phrases})($|[^{letter}])"
    asked = F.lower(_col(c)).rlike(pattern) & (F.length(strip(c)) > min_len)
    return F.coalesce(asked, F.lit(False))


def preview(c: Column | str, n: int = 120) -> Column:
    """First ``n`` characters, with dots when something was cut."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)
