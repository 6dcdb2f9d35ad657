"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for every document, the runs of consecutive words that all occur in the
test items: a phrase of the items can stand nowhere else. Exploded, the runs are postings
``(term, document, position)``. A phrase is looked up from its rarest term: that term's
postings, shifted by its offset, name the places where the phrase may start, and the runs'
other terms at the shifted offsets decide. Windows of one item at one shift share one place,
so each place is compared with the whole item once.

Edge cases: a null or empty document or item has no words and matches nothing; repeated rows
of documents are each judged, and so are different texts of one id; repeated items are one; a
null item id counts as any other but is not listed; other columns are ignored; empty tables give
empty tables or no hits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlab.llm.common import fields, map_rows, short_batches
from reviewlab.sources.stages import broadcast_if_small, materialize

WINDOW = 13
MIN_SHARE = 20  # one hit word in so many makes a document contaminated
#: Words of test items looked up at a time: their numbers and terms are sent to every task.
#: More items are taken in several groups, each with its own pass over the documents.
GROUP_WORDS = 1_000_000
#: Runs with a place whose keys are sent to every task; more are joined by shuffle.
SMALL_RUNS = 500_000

#: ASCII letters to lower case, digits and bytes of other characters kept, the rest blank.
TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TERM_BYTES).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, terms)`` of every item with words."""
    schema = T.StructType(
        [*fields(items, id_col), T.StructField("terms", T.ArrayType(T.StringType()))]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            found = map(terms_of, columns[text_col].to_pylist())
            yield {id_col: columns[id_col], "terms": [[t.decode() for t in ts] for ts in found]}

    return map_rows(items.select(id_col, text_col), work, schema).filter("size(terms) > 0")


def build_index(
    docs: DataFrame,
    numbers: dict[str, int],
    id_col: str,
    text_col: str,
    shortest: int = 1,
    gap: int = 0,
) -> DataFrame:
    """``(id, digest, n_words, runs)`` of every row of ``docs``.

    ``runs`` are ``(start, terms)``: at least ``shortest`` consecutive words that have a
    number; up to ``gap`` foreign words inside a run are kept as -1. The tasks carry the
    vocabulary of one group of test items, never that of the documents.
    """
    spark = docs.sparkSession
    short_batches(spark)
    sent = spark.sparkContext.broadcast({t.encode(): n for t, n in numbers.items()})
    run = T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
        ]
    )
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("digest", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run)),
        ]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        get = sent.value.get
        for columns in batches:
            counts, runs = [], []
            for text in columns[text_col].to_pylist():
                words = terms_of(text)
                counts.append(len(words))
                known = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                runs.append(
                    [{"start": a, "terms": known[a:b]} for a, b in _runs(known, shortest, gap)]
                )
            yield {
                "id": columns[id_col],
                "digest": columns["digest"],
                "n_words": pa.array(counts, pa.int64()),
                "runs": runs,
            }

    rows = docs.select(id_col, text_col, F.xxhash64(text_col).alias("digest"))
    return map_rows(rows, work, schema)


def _runs(known: np.ndarray, shortest: int, gap: int) -> list[tuple[int, int]]:
    at = np.flatnonzero(known >= 0)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > gap + 1)
    first, last = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
    long = last + 1 - first >= shortest
    return list(zip(first[long].tolist(), (last[long] + 1).tolist()))


def _probes(items: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """``(no, term, offset)``: the rarest term of every window of the items (no, terms).

    Windows with a term of no posting cannot occur and are left out.
    """
    placed = items.select("no", F.posexplode("terms").alias("offset", "term"))
    placed = placed.join(F.broadcast(frequency), "term", "left")
    ordered = placed.groupBy("no").agg(
        F.sort_array(F.collect_list(F.struct("offset", "term", "n"))).alias("t")
    )
    n = F.size("t")
    length = F.least(n, F.lit(window))
    windows = F.transform(
        F.sequence(F.lit(1), n - length + 1), lambda at: F.slice("t", at, length)
    )
    possible = F.filter(windows, lambda w: F.forall(w, lambda x: x["n"].isNotNull()))
    rarest = F.transform(
        possible,
        lambda w: F.array_min(
            F.transform(w, lambda x: F.struct(x["n"], x["offset"], x["term"]))
        ),
    )
    return ordered.select("no", F.explode(F.array_distinct(rarest)).alias("p")).select(
        "no", F.col("p.term").alias("term"), F.col("p.offset").alias("offset")
    )


def _exact(terms: np.ndarray, item: np.ndarray, shift: int, window: int, slack: int):
    """Spans of words inside occurring windows of ``item`` laid at ``shift`` in the run."""
    low, high = max(0, -shift), min(len(item), len(terms) - shift)
    if high <= low:
        return []
    same = terms[low + shift : high + shift] == item[low:high]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same, [0]))))
    least = min(window, len(item))
    return [
        (int(a) + low + shift, int(b) + low + shift)
        for a, b in zip(edge[::2], edge[1::2])
        if b - a >= least
    ]


def _close(terms: np.ndarray, item: np.ndarray, shift: int, window: int, slack: int):
    """Spans of ``window + slack`` words that hold all words of a window, in any order."""
    least = min(window, len(item))
    spans = []
    for at in range(len(item) - least + 1):
        wanted = Counter(item[at : at + least].tolist())
        for start in range(max(0, shift + at - slack), shift + at + slack + 1):
            part = terms[start : start + least + slack]
            if not wanted - Counter(part.tolist()):
                spans.append((start, start + len(part)))
    return spans


def _same_run(runs: DataFrame, named: DataFrame) -> Column:
    """Whether a run is the one of ``named`` (_id, _digest, _start); null ids are equal."""
    return (
        runs["id"].eqNullSafe(named["_id"])
        & (runs["digest"] == named["_digest"])
        & (runs["start"] == named["_start"])
    )


def _matches(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, window: int, slack: int | None
) -> tuple[DataFrame, DataFrame]:
    """The index of ``docs``, and ``(id, digest, item, spans)`` for one group of the items
    (no, item, terms). An item is told by its number: ids may be null or have several texts."""
    spark = docs.sparkSession
    terms = sorted({t for r in items.select("terms").toLocalIterator() for t in r.terms})
    numbers = {t: n for n, t in enumerate(terms)}
    table = [(r.no, r.item, [numbers[t] for t in r.terms]) for r in items.toLocalIterator()]
    numbered = spark.createDataFrame(table, "no long, item string, terms array<int>")
    shortest = min([window, *(len(ts) for _, _, ts in table)])
    index = materialize(
        build_index(docs, numbers, id_col, text_col, shortest, slack or 0), "index"
    )
    # A run is told by its row's digest and start; only runs with a place are moved.
    runs = index.select("id", "digest", F.inline("runs").alias("start", "terms"))
    postings = runs.select(
        "id", "digest", "start", F.posexplode("terms").alias("at", "term")
    ).filter("term >= 0")
    frequency = materialize(postings.groupBy("term").agg(F.count("*").alias("n")), "frequency")
    probes = materialize(_probes(numbered, frequency, window), "probes")
    places = materialize(
        postings.join(F.broadcast(probes), "term")
        .select("id", "digest", "start", "no", (F.col("at") - F.col("offset")).alias("shift"))
        .distinct(),
        "places",
    )
    run_key = ["id", "digest", "start"]
    named = places.select(*[F.col(c).alias(f"_{c}") for c in run_key])
    here = _same_run(runs, named)
    asked = broadcast_if_small(named.distinct(), SMALL_RUNS)
    runs = runs.join(asked, here, "left_semi").dropDuplicates(run_key)
    places = places.withColumnsRenamed({c: f"_{c}" for c in run_key})
    places = places.join(runs, _same_run(runs, places)).select(*run_key, "terms", "no", "shift")
    wanted = F.broadcast(numbered.withColumnRenamed("terms", "wanted"))
    compare = _exact if slack is None else _close
    span = T.StructType(
        [T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
    schema = T.StructType(
        [
            *fields(index, "id", "digest"),
            T.StructField("item", T.StringType()),
            T.StructField("spans", T.ArrayType(span)),
        ]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            spans = []
            for begin, shift, held, item in zip(
                columns["start"].to_pylist(),
                columns["shift"].to_pylist(),
                columns["terms"].to_pylist(),
                columns["wanted"].to_pylist(),
            ):
                found = compare(np.array(held), np.array(item), shift, window, slack or 0)
                spans.append([{"begin": begin + a, "end": begin + b} for a, b in found])
            yield {**{c: columns[c] for c in ("id", "digest", "item")}, "spans": spans}

    found = map_rows(places.join(wanted, "no"), work, schema)
    return index, found.filter("size(spans) > 0")


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    slack: int | None = None,
) -> DataFrame:
    """``(id, n_words, n_hit, items, n_items, spans)`` of every row of ``docs``.

    ``n_hit`` counts words inside an occurrence of ``window`` consecutive words of an item (or
    the whole of a shorter one); ``items`` lists the ids of the items found, sorted as strings,
    and ``n_items`` counts them, a null one too. With ``slack``, occurrences are stretches of ``slack`` words more that hold the window's words
    in any order.
    """
    return _judged(docs, items, id_col, text_col, item_col, window, slack).drop("digest")


def _judged(
    docs: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    item_col: str = "item_id",
    window: int = WINDOW,
    slack: int | None = None,
) -> DataFrame:
    """The rows of ``find_items`` with ``digest``, a hash of the text."""
    listed = materialize(
        item_terms(items, item_col, "text")
        .select(F.col(item_col).cast("string").alias("item"), "terms")
        .distinct()
        .withColumn("no", F.monotonically_increasing_id()),
        "items",
    )
    words = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, -(-words // GROUP_WORDS))
    found = None
    for g in range(groups):
        part = listed.filter(F.pmod(F.xxhash64("item", "terms"), F.lit(groups)) == g)
        index, more = _matches(docs, part, id_col, text_col, window, slack)
        found = more if found is None else found.union(more)
    # Hits of one document only: its own matches, not a key's.
    per_doc = found.groupBy("id", "digest").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.max(F.col("item").isNull().cast("bigint")).alias("unnamed"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
    )
    per_doc = per_doc.withColumnsRenamed({"id": "hit_id", "digest": "hit_digest"})
    joined = index.select("id", "digest", "n_words").join(
        per_doc,
        F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest")),
        "left",
    )
    return joined.select(
        F.col("id").alias(id_col),
        "digest",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.size("items") + F.col("unnamed"), F.lit(0)).cast("bigint").alias("n_items"),
        "spans",
    )


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(state: Column, s: Column) -> Column:
        new = F.greatest(s["end"] - F.greatest(s["begin"], state["end"]), F.lit(0))
        return F.struct(
            (state["n"] + new).alias("n"), F.greatest(state["end"], s["end"]).alias("end")
        )

    return F.aggregate(spans, start, add, lambda s: s["n"])


def contaminated(min_share: int = MIN_SHARE) -> Column:
    """The rule on ``n_hit`` and ``n_words``: at least one word in ``min_share`` is hit."""
    return (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the contaminated documents; of an id with several texts only the
    contaminated ones go."""
    found = _judged(docs, items, id_col, text_col).filter(contaminated())
    gone = found.select(F.col(id_col).alias("gone"), "digest").distinct()
    same = docs[id_col].eqNullSafe(gone["gone"]) & (F.xxhash64(docs[text_col]) == gone["digest"])
    return docs.join(gone, same, "left_anti")
