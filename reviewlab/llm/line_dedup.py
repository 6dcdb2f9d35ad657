"""Removal of lines that many sites share.

A line's spread is the number of distinct sites it stands on. Lines are hashed where the
text is stored and written once as a narrow table; a HyperLogLog sketch of the sites per
line hash, merged by aggregation, gives each spread. Lines whose estimate lies near the
threshold are counted exactly, so the decision is the exact one.

Copies of one document make all its lines stand on many sites. With ``min_texts`` a line must
stand in that many different texts as well, so copies of a text vote once; with ``copy_percent``
a text of whose words that percentage would go, a copy with small changes, stays whole. Both
leave such documents to the removal of near copies.

Edge cases: a null text stays null; blank lines and lines of fewer than ``min_words`` words
stay; a null site is no site; a text losing all lines becomes empty; repeated rows lose the
same lines; other columns are kept, those named like an output are replaced; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlab.llm.common import let
from reviewlab.sources.stages import broadcast_if_small, materialize

MIN_SITES = 10
MIN_WORDS = 4
#: Percentage of a text's words in shared lines from which it counts as a copy: two texts with
#: no more of their own than that are near copies (8 of 9 words in common give 0.8).
COPY_PERCENT = 90
#: Estimates within this share of the threshold are counted exactly.
NEAR = 0.3
#: Boilerplate lines sent to every task (16 bytes each); a longer list is joined by shuffle.
SMALL_LINES = 200_000
#: Parts into which the rows of one line hash are dealt in that shuffle.
SALTS = 16
SPACE = r"[\x20\x09-\x0D]+"


def normal_line(line: Column) -> Column:
    """White space at the ends dropped, inside made one space."""
    return F.trim(F.regexp_replace(line, SPACE, " "))


def _hashes(line: Column) -> list[Column]:
    """Two independent 64-bit hashes: together they tell any two lines apart."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def line_table(
    docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int
) -> DataFrame:
    """``(id, digest of the text, site, pos, h1, h2)`` of every line that may be removed."""
    lines = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("digest"),
        F.col(site_col).alias("site"),
        F.posexplode(F.split(text_col, "\n")).alias("pos", "line"),
    )
    lines = lines.withColumn("line", normal_line(F.col("line")))
    # A line of n words, once normal, holds n - 1 spaces.
    spaces = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    return lines.filter((F.col("line") != "") & (spaces >= min_words - 1)).select(
        "id", "digest", "site", "pos", *_hashes(F.col("line"))
    )


def salted_semi(rows: DataFrame, keys: DataFrame, on: list[str], spread_by: list[str]) -> DataFrame:
    """Rows whose key is in ``keys`` (distinct). Small ``keys`` are sent to every task; else
    each key's rows are dealt to ``SALTS`` parts, so no part holds all rows of a hot key."""
    small = broadcast_if_small(keys, SMALL_LINES)
    if small is not keys:
        return rows.join(small, on, "left_semi")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).alias("salt")
    spread = keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    spread = spread.withColumn("salt", F.col("salt").cast("bigint"))
    return rows.select("*", salt).join(spread, [*on, "salt"], "left_semi").drop("salt")


def n_words(text: Column) -> Column:
    """Words between white space."""
    words = let(normal_line(text), lambda x: F.when(x != "", F.size(F.split(x, " "))))
    return F.coalesce(words, F.lit(0))


def shared_lines(lines: DataFrame, min_sites: int, min_texts: int | None = None) -> DataFrame:
    """``(h1, h2)`` of the lines on at least ``min_sites`` distinct sites, and in at least
    ``min_texts`` different texts."""
    shared = _spread_at_least(lines, "site", min_sites)
    if min_texts is None:
        return shared
    lines = salted_semi(lines, materialize(shared, "many-sites"), ["h1", "h2"], ["id", "pos"])
    return _spread_at_least(lines, "digest", min_texts)


def _spread_at_least(lines: DataFrame, of: str, least: int) -> DataFrame:
    """``(h1, h2)`` of the lines with at least ``least`` distinct values of ``of``."""
    key = ["h1", "h2"]
    # A line of that spread occurs that often; a count is cheaper than a sketch.
    often = lines.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    often = materialize(often.select(*key), "frequent-lines")
    asked = salted_semi(lines, often, key, ["id", "pos"])
    spread = asked.groupBy(*key).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(of)).alias("spread")
    )
    spread = materialize(spread, "line-spread")
    near = spread.filter(F.abs(F.col("spread") - least) <= F.lit(NEAR) * least)
    exact = (
        salted_semi(lines, near.select(*key), key, ["id", "pos"])
        .select(*key, of)
        .distinct()
        .groupBy(*key)
        .agg(F.count(of).alias("spread"))
    )
    sure = spread.filter(F.col("spread") > F.lit(1 + NEAR) * least)
    return sure.union(exact.filter(F.col("spread") >= least)).select(*key)


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    min_texts: int | None = None,
    copy_percent: int | None = None,
) -> DataFrame:
    """``docs`` without the lines that at least ``min_sites`` sites (and ``min_texts``
    different texts) share, with the counts ``n_lines`` and ``n_removed``. Texts of which
    ``copy_percent`` of the words would go lose nothing."""
    lines = materialize(line_table(docs, id_col, text_col, site_col, min_words), "lines")
    shared = materialize(shared_lines(lines, min_sites, min_texts), "shared-lines")
    hits = (
        salted_semi(lines, shared, ["h1", "h2"], ["id", "pos"])
        .groupBy(F.col("id").alias("hit_id"), F.col("digest").alias("hit_digest"))
        .agg(F.collect_set("pos").alias("hit_pos"))
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    whole = docs.select(F.struct(*kept).alias("doc"))
    doc = F.col("doc")
    joined = whole.join(
        hits,
        doc[id_col].eqNullSafe(F.col("hit_id"))
        & (F.xxhash64(doc[text_col]) == F.col("hit_digest")),
        "left",
    )
    def without(parts: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(parts) - 1)
        left = F.array_except(places, "hit_pos")
        return F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")

    if copy_percent is not None:

        def is_copy(left: Column, text: Column) -> Column:
            return let(n_words(text), lambda n: 100 * (n - n_words(left)) >= copy_percent * n)

        left = let(F.split(doc[text_col], "\n"), without)
        joined = joined.withColumn(
            "hit_pos",
            F.when(F.col("hit_pos").isNotNull() & ~is_copy(left, doc[text_col]), F.col("hit_pos")),
        )
    text = F.when(F.col("hit_pos").isNull(), doc[text_col]).otherwise(
        let(F.split(doc[text_col], "\n"), without)
    )
    n_lines = F.size(F.split(doc[text_col], "\n"))
    return joined.select(
        *(text.alias(c) if c == text_col else doc[c].alias(c) for c in kept),
        F.when(doc[text_col].isNull(), 0).otherwise(n_lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("hit_pos"), F.lit(0)).cast("bigint").alias("n_removed"),
    )
