"""Removal of passages that occur elsewhere, by automata over repeated phrases.

A window is ``LENGTH`` words. Each has a phrase: its least hashed run of ``PHRASE`` words, the
first of equals. Equal windows have equal phrases at equal places, so windows need comparing
only where a phrase recurs. The windows that share one occurrence of a phrase are
consecutive and form a stretch; a stretch is known by the hash of its phrase and a hash of its
words, 128 bits together.

Phrases and stretches are counted first, narrow rows only. A phrase that occurs once ends there.
Where all stretches of a phrase are the same, their passage is repeated as a whole. What is left
are phrases with stretches that differ: these passages, each distinct one once with the number
of its copies, are dealt by phrase to shards of bounded size. Each shard confirms which windows
stand in several stretches, compiles them into an Aho-Corasick automaton over word numbers, and
streams its stretches through it; the automaton finds every occurrence by its words.

Every word of every document runs through the search for phrases, and every stretch with a
recurring phrase through a count or an automaton. A phrase with more different stretches than a
shard takes is counted window by window. Hot phrases and stretches meet as counters only; what
is joined back to them is broadcast, as there can be few of them (``HOT``).

Edge cases: a null text has no words; texts shorter than a window lose nothing; repeated rows are
copies of each other; null and repeated ids are fine; other columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from reviewlab.llm.common import fields, map_rows, short_batches
from reviewlab.sources.stages import materialize

#: Words of a window, and of the phrase that stands for it.
LENGTH, PHRASE = 35, 8
#: Different stretches of one phrase that a shard takes; more are counted by window.
GROUP = 1_000
#: Windows compiled into one automaton, about.
SHARD_WINDOWS = 20_000
#: Keys with more than this share of all rows are joined by broadcast: there are fewer than so
#: many.
HOT = 10_000
#: Different words a worker remembers the hash of.
HELD_WORDS = 200_000
U = np.uint64
FACTOR = 0x9E3779B97F4A7C15
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


POWERS = _powers(FACTOR, 1 << 16)
INVERSES = _powers(pow(FACTOR, -1, 1 << 64), 1 << 16)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


def range_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words from ``begin`` to ``end`` of each range."""
    powers, inverses = POWERS, INVERSES
    if len(codes) > len(powers):
        powers = _powers(FACTOR, len(codes))
        inverses = _powers(pow(FACTOR, -1, 1 << 64), len(codes))
    total = np.concatenate((np.zeros(1, U), np.cumsum(codes * powers[: len(codes)])))
    return _mix((total[end] - total[begin]) * inverses[begin])


class Words(dict):
    """Hashes of words, computed when a word is met first."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code

    def codes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U, len(words))


def split(text: str | None) -> list[bytes]:
    """The words: what stands between blanks of ASCII."""
    return (text or "").encode("utf-8", "replace").split()


def stretches(codes: np.ndarray, length: int, phrase: int) -> tuple[np.ndarray, ...]:
    """``(key, begin, windows, content)`` of each stretch of a text: the hash of its phrase, its
    first window, how many it has, and the hash of its words."""
    n = len(codes) - length + 1
    if n < 1:
        return (np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U))
    at = np.arange(len(codes) - phrase + 1)
    hashes = range_hashes(codes, at, at + phrase)
    seen = np.lib.stride_tricks.sliding_window_view(hashes, length - phrase + 1)
    anchor = seen.argmin(axis=1) + np.arange(n)
    begin = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
    windows = np.diff(np.append(begin, n))
    content = range_hashes(codes, begin, begin + windows + length - 1)
    return hashes[anchor[begin]], begin, windows, content


def stretch_table(docs: DataFrame, id_col: str, text_col: str, length: int, phrase: int) -> DataFrame:
    """``(id, digest, key, begin, windows, content)`` of every stretch of every row."""
    rows = _rows(docs, id_col, text_col)
    longs = ("digest", "key", "begin", "windows", "content")
    schema = T.StructType([*fields(rows, "id"), *(T.StructField(n, T.LongType()) for n in longs)])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        known = Words()
        for columns in batches:
            parts = []
            for text in columns["text"].to_pylist():
                parts.append(stretches(known.codes(split(text)), length, phrase))
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


def join_counted(rows: DataFrame, counted: DataFrame, key: list[str], hot: int = HOT) -> DataFrame:
    """Inner join with a table of one row per key whose ``n`` says how many ``rows`` have it.

    Fewer than ``hot`` keys can have more than one in ``hot`` rows; those are broadcast, so
    what is shuffled has no hot key. Both tables must be stored.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    bar = max(1, total // hot)
    often = F.broadcast(counted.filter(F.col("n") > bar))
    rare = rows.join(F.broadcast(often.select(*key)), key, "left_anti")
    return rows.join(often, key).unionByName(rare.join(counted.filter(F.col("n") <= bar), key))


def _texts_of(
    reps: DataFrame, docs: DataFrame, id_col: str, text_col: str, length: int
) -> DataFrame:
    """``(key, content, n, words)``: the words of each distinct stretch, from one text with it."""
    stretch = F.struct("key", "content", "n", "begin", "windows")
    asked = reps.groupBy(F.col("id").alias("a_id"), F.col("digest").alias("a_digest")).agg(
        F.collect_list(stretch).alias("asked")
    )
    rows = _rows(docs, id_col, text_col)
    joined = rows.join(
        asked, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("digest") == F.col("a_digest"))
    ).select("text", "asked")
    names = ("key", "content", "n")
    schema = T.StructType(
        [*(T.StructField(n, T.LongType()) for n in names), T.StructField("words", T.BinaryType())]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            out = {n: [] for n in schema.names}
            for text, asked in zip(columns["text"].to_pylist(), columns["asked"].to_pylist()):
                words = split(text)
                for s in asked:
                    for n in names:
                        out[n].append(s[n])
                    begin = s["begin"]
                    out["words"].append(b" ".join(words[begin : begin + s["windows"] + length - 1]))
            yield out

    return map_rows(joined, work, schema)


class Shard:
    """Distinct stretches, collected until they fill an automaton."""

    def __init__(self, length: int):
        self.length = length
        self.known = Words()
        self.clear()

    def clear(self) -> None:
        self.keys, self.texts, self.windows = [], [], 0

    def add(self, key: int, content: int, n: int, words: bytes) -> None:
        words = words.split()
        self.keys.append((key, content, n))
        self.texts.append(words)
        self.windows += len(words) - self.length + 1

    def repeated(self) -> Iterator[tuple[int, int, int, int]]:
        """``(key, content, begin, end)``: places inside a stretch that stand elsewhere too."""
        length = self.length
        sizes = np.array([len(t) for t in self.texts])
        offsets = np.cumsum(sizes) - sizes
        joined = [w for t in self.texts for w in t]
        starts = np.concatenate([o + np.arange(n - length + 1) for o, n in zip(offsets, sizes)])
        hashes = range_hashes(self.known.codes(joined), starts, starts + length)
        # Passages to confirm: windows that stand in two stretches.
        _, first, times = np.unique(hashes, return_index=True, return_counts=True)
        chosen = starts[first[times > 1]]
        if not len(chosen):
            return
        numbers: dict[bytes, int] = {}
        coded = [numbers.setdefault(w, len(numbers)) for w in joined]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for i, s in enumerate(chosen.tolist()):
            automaton.add_word(tuple(coded[s : s + length]), i)
        automaton.make_automaton()
        found, copies = [], [0] * len(chosen)
        for (_, _, n), offset, size in zip(self.keys, offsets.tolist(), sizes.tolist()):
            hits = list(automaton.iter(tuple(coded[offset : offset + size])))
            found.append(hits)
            for _, i in hits:
                copies[i] += n
        for (key, content, _), hits in zip(self.keys, found):
            spans: list[list[int]] = []
            for end, i in hits:
                if copies[i] < 2:
                    continue
                if spans and end + 1 - length <= spans[-1][1]:
                    spans[-1][1] = end + 1
                else:
                    spans.append([end + 1 - length, end + 1])
            for begin, end in spans:
                yield key, content, begin, end


PLACES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("key", "content", "begin", "end")]
)


def _by_automata(texts: DataFrame, length: int, shard_windows: int) -> DataFrame:
    """Places of repeated windows in the stretches of each phrase."""
    dealt = texts.repartition("key").sortWithinPartitions("key", "content")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        shard, last = Shard(length), None

        def out() -> dict:
            cells = list(zip(*shard.repeated())) or [[]] * 4
            shard.clear()
            return dict(zip(PLACES.names, map(list, cells)))

        for columns in batches:
            for row in zip(*(columns[c].to_pylist() for c in ("key", "content", "n", "words"))):
                # Two rows with one id and text both give their stretches.
                if row[:2] == last:
                    continue
                if shard.windows >= shard_windows and row[0] != last[0]:
                    yield out()
                shard.add(*row)
                last = row[:2]
        if shard.keys:
            yield out()

    return map_rows(dealt, work, PLACES)


def _by_counts(texts: DataFrame, length: int) -> DataFrame:
    """The same for phrases with more stretches than a shard takes, window by window."""
    names = ("key", "content", "n", "at", "window")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        known = Words()
        for columns in batches:
            counts, ats, hashes = [], [], []
            for raw in columns["words"].to_pylist():
                codes = known.codes(raw.split())
                at = np.arange(len(codes) - length + 1)
                counts.append(len(at))
                ats.append(at)
                hashes.append(range_hashes(codes, at, at + length).view(np.int64))
            which = pa.array(np.repeat(np.arange(len(counts)), counts))
            copied = {n: columns[n].take(which) for n in ("key", "content", "n")}
            yield copied | {
                "at": pa.array(np.concatenate(ats)), "window": pa.array(np.concatenate(hashes))
            }

    once = texts.dropDuplicates(["key", "content"])
    windows = materialize(map_rows(once, work, schema), "windows")
    counts = windows.groupBy("key", "window").agg(
        F.sum("n").alias("copies"), F.count(F.lit(1)).alias("n")
    )
    twice = materialize(counts.filter("copies > 1").drop("copies"), "repeated-windows")
    found = join_counted(windows.drop("n"), twice, ["key", "window"])
    return found.select(
        "key", "content", F.col("at").alias("begin"), (F.col("at") + length).alias("end")
    )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    phrase: int = PHRASE, group: int = GROUP, shard_windows: int = SHARD_WINDOWS,
) -> DataFrame:
    """``(id, digest, begin, end)``: stretches of words, of the row with this id and text hash,
    that windows standing elsewhere too cover."""
    short_batches(docs.sparkSession)
    found = materialize(stretch_table(docs, id_col, text_col, length, phrase), "stretches")

    def large(distinct: DataFrame) -> DataFrame:
        return distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group)

    return spans_of_stretches(
        found,
        lambda distinct: _texts_of(distinct, docs, id_col, text_col, length),
        large,
        lambda texts: _by_automata(texts, length, shard_windows),
        lambda texts: _by_counts(texts, length),
        length,
    )


Step = Callable[[DataFrame], DataFrame]


def spans_of_stretches(
    found: DataFrame, cut: Step, large: Step, by_shard: Step, by_count: Step, length: int
) -> DataFrame:
    """``(id, digest, begin, end)``: what repeated windows cover, from the stored stretches
    ``(id, digest, key, begin, windows, content)``.

    Keys and stretches are counted; where the stretches of a key differ, ``cut`` fetches each
    distinct one once, and ``by_shard``, or ``by_count`` for the keys that ``large`` names, finds
    the places inside it that stand in another one.
    """
    phrases = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), (F.min("content") != F.max("content")).alias("differ")
    )
    phrases = materialize(phrases.filter("n > 1"), "phrases")
    known = materialize(join_counted(found, phrases, ["key"]).drop("n"), "recurring")

    place = ["id", "digest", "begin", "windows"]
    distinct = (
        known.filter("differ")
        .groupBy("key", "content")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*place)).alias("rep"))
        .select("key", "content", "n", "rep.*")
    )
    distinct = materialize(distinct, "distinct")
    texts = materialize(cut(distinct), "stretch-words")
    many = materialize(large(distinct), "large-phrases")
    in_large = join_counted(texts.withColumnRenamed("n", "copies"), many, ["key"]).drop("n")
    in_shards = texts.join(many.select("key"), "key", "left_anti")
    places = by_shard(in_shards).unionByName(by_count(in_large.withColumnRenamed("copies", "n")))
    places = places.groupBy("key", "content").agg(
        F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("places")
    )
    whole = F.array(
        F.struct(F.lit(0).cast("bigint").alias("begin"), (F.col("windows") + length - 1).alias("end"))
    )
    judged = distinct.select("key", "content", "n", "windows").join(places, ["key", "content"], "left")
    judged = judged.select(
        "key", "content", "n", F.when(F.col("n") > 1, whole).otherwise(F.col("places")).alias("places")
    ).filter("places IS NOT NULL")
    judged = materialize(judged, "judged")

    parts = join_counted(known.filter("differ").drop("differ"), judged, ["key", "content"])
    parts = parts.select("id", "digest", F.col("begin").alias("at"), F.explode("places").alias("p"))
    parts = parts.select(
        "id", "digest", (F.col("at") + F.col("p.begin")).alias("begin"),
        (F.col("at") + F.col("p.end")).alias("end"),
    )
    alike = known.filter("NOT differ").select(
        "id", "digest", "begin", (F.col("begin") + F.col("windows") + length - 1).alias("end")
    )
    return alike.unionByName(parts)


def remove_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    phrase: int = PHRASE, group: int = GROUP, shard_windows: int = SHARD_WINDOWS,
) -> DataFrame:
    """``(id, n_words, spans, kept)`` of every row: the maximal removed runs of words, and the
    words that stay, joined by a blank."""
    spans = repeated_spans(docs, id_col, text_col, length, phrase, group, shard_windows)
    lists = spans.groupBy(F.col("id").alias("s_id"), F.col("digest").alias("s_digest")).agg(
        F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("found")
    )
    lists = materialize(lists, "phrase-spans")
    joined = _rows(docs, id_col, text_col).join(
        lists,
        F.col("id").eqNullSafe(F.col("s_id")) & (F.col("digest") == F.col("s_digest")),
        "left",
    ).select("id", "text", "found")
    span = T.StructType([T.StructField(n, T.LongType()) for n in ("begin", "end")])
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            sizes, runs, kept = [], [], []
            for text, found in zip(columns["text"].to_pylist(), columns["found"].to_pylist()):
                words = split(text)
                merged: list[list[int]] = []
                for s in found or []:
                    if merged and s["begin"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["begin"], s["end"]])
                cuts = [0, *(x for m in merged for x in m), len(words)]
                sizes.append(len(words))
                runs.append([{"begin": a, "end": b} for a, b in merged])
                kept.append(b" ".join(w for a, b in zip(cuts[::2], cuts[1::2]) for w in words[a:b]))
            yield {id_col: columns["id"], "n_words": sizes, "spans": runs, "kept": kept}

    return map_rows(joined, work, schema)
