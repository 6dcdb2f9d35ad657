"""Removal of byte strings that occur elsewhere, by suffix arrays over shards.

A window is ``LENGTH`` bytes. Each has an anchor: the start of its least hashed gram, the first
of equals. Equal windows have equal anchors at equal places, so windows need comparing only
where an anchor's gram recurs. The windows that share one anchor are consecutive and form a
stretch, known by the hash of its gram and a hash of its bytes, 128 bits together. Grams and
stretches are counted first: a gram that occurs once needs no more, and where all stretches of
a gram are the same they are repeated as a whole.

What remains are the borders of copied passages: grams with stretches that differ. Each distinct
stretch is cut once, with the number of its copies, and dealt by gram to shards of bounded
size. Shards are suffix-sorted by induced sorting, and the permuted common prefixes tell which
windows another stretch shares.

A gram with more bytes of different stretches than a shard holds is counted window by window:
no group must fit in a task.

Edge cases: a null text counts as empty; texts shorter than ``LENGTH`` lose nothing; repeated
rows are copies of each other; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reviewlab.llm.common import fields, map_rows, short_batches
from reviewlab.llm.phrase_dedup import PLACES, range_hashes, spans_of_stretches
from reviewlab.llm.suffix_array import joined, suffix_array
from reviewlab.sources.stages import materialize

LENGTH = 400
#: Bytes of the gram whose hash selects an anchor. Longer ones make more anchors and fewer
#: that occur by chance in windows that differ.
GRAM = 80
#: Bytes of one suffix array, about; a larger group of stretches is counted.
SHARD_BYTES = 2_000_000
U = np.uint64
FACTOR = 0x9E3779B97F4A7C15
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BLOCK = 1 << 16  # bytes hashed at a time, so that the powers stay a small table


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


POWERS = _powers(FACTOR, 2 * BLOCK)
INVERSES = _powers(pow(FACTOR, -1, 1 << 64), 2 * BLOCK)


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each position on."""
    parts = []
    for at in range(0, max(0, len(raw) - gram + 1), BLOCK):
        piece = raw[at : at + BLOCK + gram - 1].astype(U) + U(1)
        total = np.concatenate((np.zeros(1, U), np.cumsum(piece * POWERS[: len(piece)])))
        x = (total[gram:] - total[:-gram]) * INVERSES[: len(piece) - gram + 1]
        x = (x ^ (x >> U(30))) * MIX1
        x = (x ^ (x >> U(27))) * MIX2
        parts.append(x ^ (x >> U(31)))
    return np.concatenate(parts) if parts else np.empty(0, U)


def _sliding(x: np.ndarray, width: int, best: np.ufunc, rest: int) -> np.ndarray:
    """``best`` of each ``width`` consecutive values, from two running passes over blocks."""
    n = len(x)
    padded = np.concatenate((x, np.full(-n % width, rest, x.dtype))).reshape(-1, width)
    ahead = best.accumulate(padded, axis=1).ravel()
    back = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - width + 1], ahead[width - 1 : n])


def anchored(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(key, begin, windows, content)`` of each stretch of a text: the hash of its anchor's gram,
    its first window, how many it has, and the hash of its bytes."""
    n = len(raw) - length + 1
    if n < 1:
        return (np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U))
    hashes = gram_hashes(raw, gram)
    # The upper half of the hash decides, then the place: of equals the first.
    marked = (hashes >> U(32) << U(32)) | np.arange(len(hashes), dtype=U)
    anchor = _sliding(marked, length - gram + 1, np.minimum, (1 << 64) - 1) & U(0xFFFFFFFF)
    begin = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    windows = np.diff(np.append(begin, n))
    content = range_hashes(raw.astype(U) + U(1), begin, begin + windows + length - 1)
    return hashes[anchor[begin].astype(np.int64)], begin, windows, content


def stretch_table(
    docs: DataFrame, id_col: str, text_col: str, length: int, gram: int
) -> DataFrame:
    """``(id, digest, key, begin, windows, content)`` of every stretch of every row."""
    rows = _rows(docs, id_col, text_col)
    longs = ("digest", "key", "begin", "windows", "content")
    schema = T.StructType([*fields(rows, "id"), *(T.StructField(n, T.LongType()) for n in longs)])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            parts = []
            for text in columns["text"].to_pylist():
                raw = (text or "").encode("utf-8", "replace")
                parts.append(anchored(np.frombuffer(raw, np.uint8), length, gram))
            which = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
            key, begin, windows, content = (np.concatenate(x) for x in zip(*parts))
            yield {
                "id": columns["id"].take(which),
                "digest": columns["digest"].take(which),
                "key": pa.array(key.view(np.int64)),
                "begin": pa.array(begin),
                "windows": pa.array(windows),
                "content": pa.array(content.view(np.int64)),
            }

    return map_rows(rows, work, schema)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("digest")
    )


def _cut(distinct: DataFrame, docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``(key, content, n, bytes)``: each distinct stretch, from one text with it."""
    stretch = F.struct("key", "content", "n", "begin", "windows")
    asked = distinct.groupBy(F.col("id").alias("a_id"), F.col("digest").alias("a_digest")).agg(
        F.collect_list(stretch).alias("asked")
    )
    joined_ = _rows(docs, id_col, text_col).join(
        asked, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("digest") == F.col("a_digest"))
    ).select("text", "asked")
    names = ("key", "content", "n")
    schema = T.StructType(
        [*(T.StructField(n, T.LongType()) for n in names), T.StructField("bytes", T.BinaryType())]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            out = {n: [] for n in schema.names}
            for text, asked in zip(columns["text"].to_pylist(), columns["asked"].to_pylist()):
                raw = text.encode("utf-8", "replace")
                for s in asked:
                    for n in names:
                        out[n].append(s[n])
                    out["bytes"].append(raw[s["begin"] : s["begin"] + s["windows"] + length - 1])
            yield out

    return map_rows(joined_, work, schema)


def _flagged_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags, [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def judge(shard: list[tuple], length: int) -> dict:
    """Places inside the stretches ``(key, content, n, bytes)`` whose windows another one has."""
    # Bytes from 2 on, 1 between stretches, 0 at the end.
    parts = []
    for *_, raw in shard:
        parts += [np.frombuffer(raw, np.uint8).astype(np.uint16) + np.uint16(2), np.ones(1, np.uint16)]
    t = np.concatenate([*parts, np.zeros(1, np.uint16)])
    order = suffix_array(t)
    # Suffixes that share a window follow one another. A window stands in a stretch once.
    first = np.flatnonzero(~joined(t, order, length))
    sizes = np.diff(np.append(first, len(t)))
    shared = np.zeros(len(t), bool)
    shared[order] = np.repeat(sizes > 1, sizes)
    out, at = {n: [] for n in PLACES.names}, 0
    for key, content, n, raw in shard:
        if n == 1:  # the others are repeated as a whole and only compared with
            for a, b in _flagged_runs(shared[at : at + len(raw) - length + 1]):
                for name, value in zip(PLACES.names, (key, content, a, b - 1 + length)):
                    out[name].append(value)
        at += len(raw) + 1
    return out


def sort_shards(texts: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """``(key, content, begin, end)`` of what other stretches share. Stretches of one key lie in
    one suffix array; several keys fill an array."""
    dealt = texts.repartition("key").sortWithinPartitions("key", "content")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        shard, size, last = [], 0, None
        for columns in batches:
            for row in zip(*(columns[c].to_pylist() for c in ("key", "content", "n", "bytes"))):
                # Two rows with one id and text both give their stretches.
                if row[:2] == last:
                    continue
                if shard and size >= shard_bytes and row[0] != last[0]:
                    yield judge(shard, length)
                    shard, size = [], 0
                shard.append(row)
                size += len(row[3]) + 1
                last = row[:2]
        if shard:
            yield judge(shard, length)

    return map_rows(dealt, work, PLACES)


def count_windows(texts: DataFrame, length: int) -> DataFrame:
    """The same for grams with more stretches than a shard holds, window by window."""
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.length("bytes") - F.lit(length)))
    once = texts.dropDuplicates(["key", "content"])
    single = once.select("key", "content", "n", "bytes", at.alias("at"))
    body = F.col("bytes").substr((F.col("at") + 1).cast("int"), F.lit(length))
    window = F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit("window"), body).alias("b"))
    single = materialize(single.select("key", "content", "n", "at", window.alias("window")), "windows")
    twice = single.groupBy("key", "window").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    return single.join(twice, ["key", "window"]).select(
        "key", "content", F.col("at").alias("begin"), (F.col("at") + length).alias("end")
    )


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(id, digest, begin, end)``: byte spans, possibly overlapping, that together cover the
    bytes inside windows of ``length`` bytes that start anywhere else too."""
    short_batches(docs.sparkSession)
    found = materialize(stretch_table(docs, id_col, text_col, length, gram), "stretches")

    def large(distinct: DataFrame) -> DataFrame:
        size = F.sum(F.col("windows") + length)
        sized = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n"), size.alias("size"))
        return sized.filter(F.col("size") > shard_bytes).drop("size")

    return spans_of_stretches(
        found,
        lambda distinct: _cut(distinct, docs, id_col, text_col, length),
        large,
        lambda texts: sort_shards(texts, length, shard_bytes),
        lambda texts: count_windows(texts, length),
        length,
    )


def remove_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(id, n_bytes, spans, kept)`` of every row: the maximal removed runs, and the bytes
    that stay."""
    spans = repeated_spans(docs, id_col, text_col, length, gram, shard_bytes)
    spans = materialize(spans, "spans")
    lists = spans.groupBy(F.col("id").alias("s_id"), F.col("digest").alias("s_digest")).agg(
        F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("found")
    )
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("digest")
    )
    joined = rows.join(
        lists,
        F.col("id").eqNullSafe(F.col("s_id")) & (F.col("digest") == F.col("s_digest")),
        "left",
    ).select("id", "text", "found")
    span = T.StructType([T.StructField(n, T.LongType()) for n in ("begin", "end")])
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            sizes, runs, kept = [], [], []
            for text, found in zip(columns["text"].to_pylist(), columns["found"].to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                merged: list[list[int]] = []
                for s in found or []:
                    if merged and s["begin"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["begin"], s["end"]])
                cuts = [0, *(x for m in merged for x in m), len(raw)]
                sizes.append(len(raw))
                runs.append([{"begin": a, "end": b} for a, b in merged])
                kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            yield {id_col: columns["id"], "n_bytes": sizes, "spans": runs, "kept": kept}

    return map_rows(joined, work, schema)
