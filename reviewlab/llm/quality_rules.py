"""Quality rules: a threshold table compiled into one projection.

Every measure is a column expression over the row's own text, so nothing is exchanged and
no user function runs. A rule keeps a text whose ratio lies between its bounds.

Edge cases: a null or empty text has no words, fails the base rules and is not kept; repeated
rows are each judged; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from reviewlab.llm.common import let

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words

# Frequent function words of the languages the tables hold.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on are with as be this at by from or an not have",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más",
}


class Rule(NamedTuple):
    """Keep a text when ``low <= numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float


# The default thresholds. Ratios are per word, per character or per line.
RULES = [
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.03, 1.0),
    Rule("letters", "n_letters", "word_chars", 0.6, 1.0),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 0.0, 0.5),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", 0.0, 0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", 0.0, 0.9),
]


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds at least twice.

    A window is compared by a 64-bit hash of its words. Only texts with a repeated window
    pay for sorting them by position.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def starts(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"]))
                | (F.get(s, i + 1)["h"].eqNullSafe(x["h"])),
            )
            return F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))

        return let(placed, lambda s: F.size(F.array_distinct(F.flatten(starts(s)))))

    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)),
    )


def measures(text: Column) -> Column:
    """Counts of one text as a struct of longs."""
    def count(words: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            joined = F.array_join(words, "")
            counts = {
                "n_words": F.size(words),
                "word_chars": F.length(joined),
                "n_symbols": F.regexp_count(text, F.lit(SYMBOL)),
                "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
                "n_repeat_words": _repeated_words(words),
                "n_letters": F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", "")),
                "n_lines": F.size(lines),
                "n_stop_words": F.size(
                    F.filter(F.transform(words, F.lower), lambda w: w.isin(*known_words()))
                ),
                "n_ellipsis_lines": F.size(
                    F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))
                ),
                "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))),
            }
            return F.struct(*(c.cast("bigint").alias(n) for n, c in counts.items()))

        return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), of_lines)

    return let(F.array_remove(F.split(text, SPACE), ""), count)


def known_words() -> list[str]:
    return sorted({w for ws in STOP_WORDS.values() for w in ws.split()})


def apply_rules(
    df: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, measures, base_failed, one passed_<rule> per rule, kept)`` of every row."""
    m = F.col("m")
    measured = df.select(
        F.col(id_col), measures(F.coalesce(F.col(text_col), F.lit(""))).alias("m")
    )
    base_failed = (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"]
    )
    passed = {
        r.name: (m[r.numerator] >= r.low * m[r.denominator])
        & (m[r.numerator] <= r.high * m[r.denominator])
        for r in rules
    }
    kept = ~base_failed
    for ok in passed.values():
        kept = kept & ok
    return measured.select(
        id_col,
        "m.*",
        base_failed.alias("base_failed"),
        *(ok.alias(f"passed_{n}") for n, ok in passed.items()),
        kept.alias("kept"),
    )
