"""How far the sources of one language differ in the terms they use, from count-level bitmaps.

Inside one source a term's probability depends on nothing but its count, so a source is held
as bitsets: for each (source, count) the numbers of the terms that occur so often, in words of
64 terms. Two sources are compared level by level. AND and popcount of two bitsets give the
number of terms in a joint cell, which is multiplied by the difference of the two
probabilities. Terms one side lacks are no bitset; their cells are the complement, the level's
size less what its joint cells hold.

Term numbers follow the language's own frequency, so terms of like counts share words and
a word holds few levels. Sources are dealt to tiles and terms to parts: a task compares the
sources of two tiles over one part, and what it holds is bounded by both sizes. All sums are of
integers.

Edge cases: null text, language and source count as empty strings; a row without terms still
makes its source occur; repeated rows count as rows; a language without kept terms gives
differences of 0; texts of any length are read whole; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window
from pyspark.sql.pandas.types import to_arrow_schema

from reviewlab.llm.common import map_rows, short_batches
from reviewlab.operators.joins import lookup_join
from reviewlab.sources.stages import materialize

#: Documents of its language that a kept term stands in at least.
MIN_DOCS = 30
#: Rows of the ``term`` part for each source.
TOP_TERMS = 50
#: The smoothing and the scale of a probability.
PRIOR, SCALE = 5, 1_000_000_000
#: Terms numbered together, sources of one tile, and terms of one part: what a task holds.
BLOCK_TERMS, TILE, PART_TERMS = 4_096, 32, 16_384
#: Distinct terms a worker counts before it hands its counts on.
HELD_TERMS = 200_000
#: Rows of facts about sources or languages that are sent to every task.
SMALL = 20_000

_UPPER = range(0x41, 0x5B)
#: Bytes of terms as they count, all others blanks. Bytes above 0x7F belong to terms.
FOLD = bytes(
    b + 32 if b in _UPPER else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("docs", T.LongType()),
    ]
)


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and rows with the term."""
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def out() -> dict:
            made = {name: [] for name in COUNTS.names}
            for (lang, source), (times, rows) in held.items():
                made["lang"] += [lang] * len(times)
                made["source"] += [source] * len(times)
                made["term"] += times
                made["n"] += times.values()
                made["docs"] += map(rows.__getitem__, times)
            held.clear()
            return made | {"term": pa.array(made["term"], pa.binary())}

        for columns in batches:
            for lang, source, raw in zip(*(columns[c].to_pylist() for c in ("lang", "source", "text"))):
                terms = raw.translate(FOLD).split()
                times, rows = held.setdefault((lang, source), (Counter(), Counter()))
                times.update(terms)
                rows.update(set(terms))
            if sum(len(times) for times, _ in held.values()) > HELD_TERMS:
                yield out()
        yield out()

    short_batches(docs.sparkSession)
    counted = map_rows(rows, work, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _share(n: Column | str, total: str, terms: str) -> Column:
    """The scaled probability of a count; 38 digits, so no product overflows."""
    n, total, terms = (F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c for c in (n, total, terms))
    top = (n + F.lit(PRIOR)) * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", top, total + F.lit(PRIOR) * terms)
    return F.when(terms > 0, whole + 1).otherwise(0).cast("bigint")


def number_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, all_n, at, bit)`` of the kept terms: the word and the bit of their number.

    Terms are numbered inside classes of like frequency; large classes are cut by hash, so no
    numbering sorts more than a block or so.
    """
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs)
        .withColumn("size_class", F.floor(4 * F.log2("all_n")).cast("int"))
    )
    kept = materialize(kept, "kept-terms")
    sizes = kept.groupBy("lang", "size_class").agg(F.count(F.lit(1)).alias("members"))
    kept = lookup_join(kept, sizes, ["lang", "size_class"], SMALL, "inner")
    cut = F.expr(f"pmod(xxhash64(term), members div {BLOCK_TERMS} + 1)")
    kept = kept.withColumn("cut", cut)
    number = F.row_number().over(Window.partitionBy("lang", "size_class", "cut").orderBy("term")) - 1
    return kept.select(
        "lang",
        "term",
        "all_n",
        F.expr("shiftleft(cast(size_class as bigint), 48) + shiftleft(cut, 16)").alias("block"),
        number.alias("number"),
    ).select(
        "lang",
        "term",
        "all_n",
        (F.col("block") + F.expr("number div 64")).alias("at"),
        (F.col("number") % 64).cast("int").alias("bit"),
    )


def _facts(docs: DataFrame, own: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, total, terms, lang_total, tiles, parts)`` of every source that occurs."""
    groups = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")
    ).distinct()
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialize(groups.join(totals, ["lang", "source"], "left"), "sources")
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    langs = langs.join(
        kept.groupBy("lang").agg(
            F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("lang_total")
        ),
        "lang",
        "left",
    ).select(
        "lang",
        F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.expr(f"(n_sources + {TILE - 1}) div {TILE}").alias("tiles"),
        F.expr(f"coalesce(terms, 0) div {PART_TERMS} + 1").alias("parts"),
    )
    facts = lookup_join(groups, langs, "lang", SMALL, "inner")
    return materialize(facts.withColumn("total", F.coalesce("total", F.lit(0))), "source-facts")


#: What a task gets: the sources of its two tiles (``at`` is null, ``p`` of a count of 0, ``n``
#: the language's kept terms), and their bitsets.
CELLS = ["lang", "source", "part", "a", "b", "at", "p", "bits", "n"]
PAIRS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)


def _to_tiles(df: DataFrame) -> DataFrame:
    """Each row once for every pair of tiles its source's tile is in."""
    other = F.explode(F.expr("sequence(0L, tiles - 1)")).alias("other")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    spread = df.select("*", tile.alias("tile"), other)
    return spread.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))


def joint_value(x: tuple, y: tuple) -> int:
    """The difference of two sources over one part, less the terms that both lack.

    Each is ``(at, p, bits, p0)``: words in ascending order, probabilities and bitsets of its
    levels, and the probability of a term it lacks.
    """
    (at, p, bits, p0), (at2, q, bits2, q0) = x, y
    first = np.searchsorted(at2, at, "left")
    times = np.searchsorted(at2, at, "right") - first
    left = np.repeat(np.arange(len(at)), times)
    right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first[left]
    cells = np.bitwise_count(bits[left] & bits2[right]).astype(np.int64)
    own, other, none = np.abs(p - q0), np.abs(q - p0), abs(p0 - q0)
    joint = np.abs(p[left] - q[right]) - own[left] - other[right] + none
    size, size2 = (np.bitwise_count(b).astype(np.int64) for b in (bits, bits2))
    # A level's terms that the other side lacks are its size less its joint cells.
    alone = size @ (own - none) + size2 @ (other - none)
    return int(cells @ joint + alone)


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    lang, part, a, b = (k.as_py() for k in key)
    heads = table.filter(pa.compute.is_null(table["at"]))
    cells = table.filter(pa.compute.is_valid(table["at"])).sort_by([("source", "ascending"), ("at", "ascending")])
    names = cells["source"].combine_chunks().dictionary_encode()
    ats, ps = cells["at"].to_numpy(), cells["p"].to_numpy()
    bits = cells["bits"].to_numpy().view(np.uint64)
    codes = names.indices.to_numpy() if len(cells) else np.empty(0, np.int64)
    ranges = {
        name: slice(*np.searchsorted(codes, [i, i + 1])) for i, name in enumerate(names.dictionary.to_pylist())
    }
    held = {}
    for source, p0, tile in zip(*(heads[c].to_pylist() for c in ("source", "p", "tile"))):
        s = ranges.get(source, slice(0, 0))
        held[source] = (tile, (ats[s], ps[s], bits[s], p0))
    terms = heads["n"][0].as_py() if part == 0 and len(heads) else 0
    out = {"source": [], "item": [], "value": []}
    order = list(held)
    for i, source in enumerate(order):
        for item in order[i + 1 :]:
            (tile, x), (tile2, y) = held[source], held[item]
            if a != b and tile == tile2:
                continue
            value = joint_value(x, y) + terms * abs(x[3] - y[3])
            out["source"] += [source, item]
            out["item"] += [item, source]
            out["value"] += [value, value]
    return pa.table({"lang": [lang] * len(out["value"]), **out}, schema=to_arrow_schema(PAIRS))


def pair_values(own: DataFrame, facts: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for any two sources of a language, both ways."""
    one = F.lit(1).cast("bigint")
    levels = own.groupBy("lang", "source", "at", "n").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")
    )
    levels = lookup_join(levels, facts, ["lang", "source"], SMALL, "inner")
    block = F.expr("shiftright(at, 16)")
    levels = levels.withColumn("p", _share("n", "total", "terms")).withColumn(
        "part", F.pmod(F.xxhash64(block), F.col("parts"))
    )
    heads = facts.select(
        "*",
        F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"),
        F.lit(None).cast("bigint").alias("at"),
        F.lit(None).cast("bigint").alias("bits"),
    ).withColumn("p", _share(F.lit(0).cast("decimal(20,0)"), "total", "terms"))
    names = [*CELLS, "tile"]
    rows = _to_tiles(levels).select(*names).unionByName(
        _to_tiles(heads.withColumn("n", one * F.col("terms"))).select(*names)
    )
    found = rows.groupBy("lang", "part", "a", "b").applyInArrow(_compare, PAIRS)
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(own: DataFrame, facts: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, item, value, rank)`` of the terms a source uses most above its language."""
    rows = lookup_join(own, facts, ["lang", "source"], SMALL, "inner").select(
        "lang",
        "source",
        F.col("term").alias("item"),
        (_share("n", "total", "terms") - _share("all_n", "lang_total", "terms")).alias("value"),
    )
    return _ranked(rows.filter("value > 0")).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: every other source of the language by its
    difference, and the terms most above the language's own use."""
    counts = materialize(count_terms(docs), "term-counts")
    kept = materialize(number_terms(counts, min_docs), "term-numbers")
    own = materialize(
        counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-counts"
    )
    facts = _facts(docs, own, kept)
    pairs = _ranked(pair_values(own, facts)).withColumn("part", F.lit("pair"))
    terms = term_values(own, facts, top).withColumn("part", F.lit("term"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*names).unionByName(terms.select(*names))
