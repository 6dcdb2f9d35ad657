"""Near-duplicate groups by SuperMinHash, banding, exact verification and union-find.

A document is the set of its word shingles. Its signature is a SuperMinHash: every shingle
deals a random permutation of the slots, one rank per round, and a slot keeps the smallest
``round + fraction`` it is dealt. Ranks of one shingle are correlated, which lowers the
variance, and a document stops as soon as no later round can lower any slot. Documents with
one set are one class; one representative per class is banded. Members of a bucket are
compared with its leader, then what the leader left apart is compared across groups, in large
buckets by tiles of bounded size, always on the full sets. Links are joined by alternating star contractions, which never gather a
component in one place.

Edge cases: a null or blank text has no shingles and stays alone; a null id stays alone with
a null component; rows with one id and one text share a component; rows with one id and
different texts are linked by their texts only, each has the component of its own text, and a
component is named after the smallest id in it; other columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reviewlab.llm.common import fields, map_rows, short_batches
from reviewlab.sources.stages import broadcast_if_small, materialize

SHINGLE_WORDS = 5
MIN_PERCENT = 80
#: Two documents at 0.8 miss all bands with a probability of 0.672 ** 32 = 3e-6.
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: Members of a bucket that are compared in pairs when its leader leaves some apart; those of
#: a larger bucket are compared in tiles of so many queries and members.
SMALL_BUCKET, TILE = 16, 512
#: Parts over which the rows of one key are dealt in joins with a table of keys.
SALTS = 16
#: Documents in a pair whose keys are sent to every task; more are joined by shuffle.
SMALL_IDS = 1_000_000
#: Pairs of one document that meet its set in one task; more are dealt to several.
SPLIT_PAIRS = 4_096
#: Words whose hashes a worker remembers before it starts afresh.
CACHE_WORDS = 150_000
#: Documents whose signatures are computed together.
SKETCHED = 64
U = np.uint64
GOLDEN, MIX1, MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
FREE = U(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


class WordHashes(dict):
    """64-bit hashes by word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = h
        return h


WORDS = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    Lower-casing and splitting bytes touches ASCII letters and ASCII white space only.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, U)
    h = np.fromiter(map(WORDS.__getitem__, words), U, n)
    k = min(size, n)
    x = np.full(n - k + 1, k, U)
    for i in range(k):
        x = mix((x + GOLDEN) ^ h[i : n - k + 1 + i])
    return np.unique(x)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set, one row each: ``round << 32 | fraction`` per slot."""
    out = np.full((len(sets), slots), FREE, U)
    if not sets:
        return out
    flat = out.reshape(-1)
    x = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    ranks = None
    for j in range(slots):
        if j:
            # A document with every slot below this round's values is finished.
            open_ = out.max(axis=1) >= U(j << 32)
            live = open_[owner]
            if not live.any():
                break
            if not live.all():
                x, owner = x[live], owner[live]
                ranks = ranks[live] if ranks is not None else None
            if ranks is None:
                ranks = np.tile(np.arange(slots, dtype=np.uint16), (len(x), 1))
                rows, k = np.arange(len(x)), _draw(x, 0, slots)[1]
                ranks[rows, k], ranks[:, 0] = 0, k
        fraction, k = _draw(x, j, slots)
        if ranks is None:
            slot = k
        else:
            rows = np.arange(len(x))
            slot = ranks[rows, k].astype(np.int64)
            ranks[rows, k] = ranks[:, j]
            ranks[:, j] = slot
        np.minimum.at(flat, owner * slots + slot, fraction | U(j << 32))
    return out


def _draw(x: np.ndarray, j: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Round ``j`` of each shingle's own generator: a fraction and a place from ``j`` on."""
    y = mix(x + U(int(GOLDEN) * (j + 1) & int(FREE)))
    place = ((y & U(0xFFFFFFFF)) * U(slots - j) >> U(32)).astype(np.int64) + j
    return y >> U(32), place


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U), (len(signature), bands)).copy()
    for r in range(rows):
        key = mix((key + GOLDEN) ^ parts[:, :, r])
    return key


def sketch(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(id, stamp, n_shingles, digest, bands)`` of every row; blank texts have no bands.

    ``stamp`` is a hash of the text: an id and a stamp tell a row from others of its id."""
    short_batches(df.sparkSession)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            sets = [shingle_set(t, size) for t in columns[text_col].to_pylist()]
            # Ranks take slots x shingles bytes: a part of the batch at a time.
            parts = [signatures(sets[a : a + SKETCHED]) for a in range(0, len(sets), SKETCHED)]
            keys = band_keys(np.concatenate([signatures([]), *parts])).view(np.int64)
            yield {
                "id": columns[id_col],
                "stamp": columns["stamp"],
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "digest": [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ],
                "bands": [k if len(s) else None for s, k in zip(sets, keys)],
            }

    schema = T.StructType(
        [
            T.StructField("id", df.schema[id_col].dataType),
            T.StructField("stamp", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    rows = df.select(id_col, text_col, F.xxhash64(text_col).alias("stamp"))
    return map_rows(rows, work, schema)


def salted_join(
    rows: DataFrame, keys: DataFrame, on: str, spread_by: str, how: str = "inner"
) -> DataFrame:
    """Join ``rows`` with a table that holds each value of ``on`` once, dealing the rows of
    each value to ``SALTS`` parts: no part gets all rows of a hot one."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    spread = keys.withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    )
    return salted.join(spread, [on, "salt"], how).drop("salt")


def sets_of(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(id, set, short)`` of the classes in ``asked`` (id, head, stamp), read from the texts of
    their heads: the full sets as 64-bit integers, and the upper halves of these."""
    texts = docs.select(
        F.col(id_col).alias("head"), F.xxhash64(text_col).alias("stamp"), F.col(text_col).alias("text")
    )
    # Repeated rows are dropped where the join has brought them together.
    texts = texts.join(broadcast_if_small(asked, SMALL_IDS), ["head", "stamp"])
    texts = texts.select("id", "text").dropDuplicates(["id"])
    schema = T.StructType(
        [*fields(texts, "id")] + [T.StructField(n, T.BinaryType()) for n in ("set", "short")]
    )

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            found = [shingle_set(t, size) for t in columns["text"].to_pylist()]
            yield {
                "id": columns["id"],
                "set": [s.astype("<u8").tobytes() for s in found],
                "short": [(s >> U(32)).astype("<u4").tobytes() for s in found],
            }

    short_batches(docs.sparkSession)
    return map_rows(texts, work, schema)


def _links_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("u", kind), T.StructField("v", kind)])


def _with_set(pairs: DataFrame, sets: DataFrame, on: str, name: str) -> DataFrame:
    """``pairs`` with the set of the document in ``on`` as ``name``. The pairs of a document in
    very many of them, such as the leader of a large bucket, are dealt to parts by the other
    end, and its set is repeated for each part; other sets are not."""
    other = "v" if on == "u" else "u"
    parts = F.ceil(F.col("n") / SPLIT_PAIRS).alias("parts")
    busy = pairs.groupBy(on).agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT_PAIRS)
    busy = materialize(busy.select(on, parts), "busy")
    first = F.lit(0).cast("bigint")
    dealt = salted_join(pairs, busy, on, other, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64(other), F.col("parts")), first)
    )
    held = sets.select(F.col("id").alias(on), F.col("set").alias(name)).join(busy, on, "left")
    held = held.withColumn(
        "part", F.explode(F.sequence(first, F.coalesce(F.col("parts"), F.lit(1)) - 1))
    )
    return dealt.drop("parts").join(held.drop("parts"), [on, "part"]).drop("part")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough."""

    def compare(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            near = []
            for a, b in zip(columns["a"].to_pylist(), columns["b"].to_pylist()):
                x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                both = len(x) + len(y)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    near.append(False)
                    continue
                union = len(np.union1d(x, y))
                near.append(100 * (both - union) >= percent * union)
            yield {c: columns[c].filter(pa.array(near, pa.bool_())) for c in ("u", "v")}

    # The member's set comes first: a leader has many pairs, most members have a few.
    both = _with_set(_with_set(pairs, sets, "v", "b"), sets, "u", "a").select("u", "v", "a", "b")
    return map_rows(both, compare, _links_schema(sets.schema["id"].dataType))


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every node in ``edges`` (u, v): the smallest node reachable.

    Alternates two contractions: large-star links a node's larger neighbours to its smallest
    neighbour, small-star its smaller ones; when nothing changes, every component is a star
    around its smallest node. Minima are aggregated before they are joined back, with salts.
    """
    both = edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges, state = materialize(both.distinct(), "edges"), None
    while True:
        ways = edges.union(edges.select("v", "u"))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = ways.filter("v > u")
        edges = salted_join(larger, least, "u", "v").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        edges = materialize(edges.filter("u != v").distinct(), "large-star")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = salted_join(edges, least, "u", "v").select(F.col("v").alias("u"), "m")
        edges = moved.union(least).filter("u != m").distinct().withColumnRenamed("m", "v")
        edges = materialize(edges, "small-star")
        before, state = state, edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )


def _unsettled(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """``(key, id, leader, n, group, first)`` of the buckets whose members are in several
    groups; ``first`` is the leader's group."""
    held = buckets.join(groups, "id", "left")
    held = held.withColumn("group", F.coalesce("component", "id")).drop("component")
    own = (
        held.groupBy("key")
        .agg(
            F.min("group").alias("least"),
            F.max("group").alias("most"),
            F.min(F.when(F.col("id") == F.col("leader"), F.col("group"))).alias("first"),
        )
        .filter("least != most")
    )
    return salted_join(held, own.select("key", "first"), "key", "id")


def _remaining_pairs(unsettled: DataFrame) -> DataFrame:
    """Pairs of a small bucket that its leader did not settle: a member outside the leader's
    group against every member of another group."""
    held = unsettled.filter((F.col("n") <= SMALL_BUCKET) & (F.col("id") != F.col("leader")))
    apart = held.filter("group != first").select(
        "key", F.col("id").alias("v"), F.col("group").alias("g")
    )
    pairs = held.join(apart, "key").filter(
        (F.col("group") != F.col("g"))
        & ((F.col("group") == F.col("first")) | (F.col("id") < F.col("v")))
    )
    return pairs.select(F.least("id", "v").alias("u"), F.greatest("id", "v").alias("v")).distinct()


def _tile_pairs(unsettled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that may be links in large buckets, between a member outside the leader's group,
    the query, and the members of other groups: those that halved hashes cannot rule out.

    Queries and members are dealt to tiles of bounded size; a tile counts common shingles
    through an index of its members. Halved hashes count too many, never too few: two of them
    collide within a pair of documents about once in 10^5, two pairs once in 10^10.
    """
    held = unsettled.filter(F.col("n") > SMALL_BUCKET)
    apart = F.col("group") != F.col("first")
    sizes = held.groupBy("key").agg(F.sum(apart.cast("bigint")).alias("s"))

    def blocks(count: str) -> Column:
        return F.ceil(F.col(count) / TILE)

    def places(query: bool) -> Column:
        own = F.pmod(F.xxhash64("id"), blocks("s" if query else "n"))
        others = F.sequence(F.lit(0).cast("bigint"), blocks("n" if query else "s") - 1)
        names = ("q", "m") if query else ("m", "q")

        def place(other: Column) -> Column:
            ends = dict(zip(names, (own, other)))
            return F.struct(
                ends["q"].alias("q"), ends["m"].alias("m"), F.lit(query).alias("query")
            )

        return F.transform(others, place)

    dealt = F.when(apart, F.concat(places(True), places(False))).otherwise(places(False))
    tiles = (
        salted_join(held, sizes, "key", "id")
        .join(sets.select("id", "short"), "id")
        .select("key", "id", "group", "short", F.inline(dealt))
    )

    def compare(tile: pa.Table) -> pa.Table:
        query = tile["query"].to_numpy(zero_copy_only=False)
        ids, of = tile["id"].to_pylist(), tile["group"].to_pylist()
        members = np.flatnonzero(~query)
        found = [np.frombuffer(s, "<u4") for s in tile["short"].to_pylist()]
        if not len(members) or not query.any():
            return pa.table({"u": [], "v": []}, schema=arrow)
        sizes = np.array([len(found[i]) for i in members])
        owner = np.repeat(np.arange(len(members)), sizes)
        words = np.concatenate([found[i] for i in members])
        order = np.argsort(words, kind="stable")
        words, owner = words[order], owner[order]
        pairs = []
        for q in np.flatnonzero(query):
            low, high = np.searchsorted(words, found[q]), np.searchsorted(words, found[q], "right")
            count = high - low
            at = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count)
            both = np.bincount(owner[at + np.arange(len(at))], minlength=len(members))
            total = sizes + len(found[q])
            near = np.flatnonzero(100 * both >= percent * (total - both))
            # Of a group, one pair is enough if it holds with one shingle less.
            sure = 100 * (both - 1) >= percent * (total - both + 1)
            done = {of[q]}
            for k in sorted(near.tolist(), key=lambda k: not sure[k]):
                if of[members[k]] not in done:
                    pairs.append((ids[q], ids[members[k]]))
                    if sure[k]:
                        done.add(of[members[k]])
        return pa.table(
            {"u": [min(p) for p in pairs], "v": [max(p) for p in pairs]}, schema=arrow
        )

    schema = _links_schema(sets.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    return tiles.groupBy("key", "q", "m").applyInArrow(compare, schema)


def _placed(
    docs: DataFrame, id_col: str, text_col: str, size: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """The sketches, and ``(digest, head)`` of the classes with several rows or in a group with
    others: ``head`` holds ``id`` and ``stamp`` of the smallest row of the whole group."""
    sketches = materialize(sketch(docs, id_col, text_col, size), "sketches")
    known = sketches.filter("id is not null and digest is not null")
    # A class is told by a number, for an id may stand for several texts.
    classes = known.groupBy("digest").agg(
        F.min(F.struct("id", "stamp")).alias("head"), F.count("*").alias("n")
    )
    classes = materialize(
        classes.withColumn("node", F.monotonically_increasing_id()), "classes"
    )
    heads = known.join(
        classes.select("digest", "node", "head.id", "head.stamp"), ["digest", "id", "stamp"]
    )
    heads = heads.select("node", "bands").dropDuplicates(["node"])
    banded = heads.select(F.col("node").alias("id"), F.explode("bands").alias("key"))
    leaders = (
        banded.groupBy("key")
        .agg(F.min("id").alias("leader"), F.max("id").alias("last"), F.count("*").alias("n"))
        .filter("leader != last")
        .drop("last")
    )
    buckets = materialize(salted_join(banded, leaders, "key", "id"), "buckets")
    pairs = materialize(
        buckets.filter("id != leader")
        .select(F.col("leader").alias("u"), F.col("id").alias("v"))
        .distinct(),
        "pairs",
    )
    paired = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    asked = classes.join(paired, "node", "left_semi").select(
        F.col("node").alias("id"), F.col("head.id").alias("head"), F.col("head.stamp").alias("stamp")
    )
    sets = materialize(sets_of(docs, asked, id_col, text_col, size), "sets")
    links = materialize(verified(pairs, sets, percent), "links")
    groups = materialize(components(links), "groups")
    unsettled = materialize(_unsettled(buckets, groups), "unsettled")
    rest = _remaining_pairs(unsettled).union(_tile_pairs(unsettled, sets, percent)).distinct()
    more = materialize(verified(materialize(rest, "pairs"), sets, percent), "links")
    if not more.isEmpty():
        groups = materialize(components(links.union(more)), "groups")

    linked = classes.select("node", "head").join(groups.withColumnRenamed("id", "node"), "node")
    first = linked.groupBy("component").agg(F.min("head").alias("first"))
    linked = salted_join(linked.select("node", "component"), first, "component", "node")
    placed = (
        classes.join(linked.select("node", "first"), "node", "left")
        .filter("n > 1 or first is not null")
        .select("digest", F.coalesce("first", "head").alias("head"))
    )
    return sketches, placed


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    percent: int = MIN_PERCENT,
) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row.

    Rows of one set are linked through their class; only different sets are compared.
    """
    sketches, placed = _placed(docs, id_col, text_col, size, percent)
    rows = sketches.select("id", "n_shingles", "digest")
    joined = salted_join(rows, placed, "digest", "id", "left")
    return joined.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("head.id", "id")).alias("component_id"),
    )


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    percent: int = MIN_PERCENT,
) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, and of several texts
    of this id in the group, any one. Of rows that repeat id and text one stays, whatever their
    other columns hold. Rows without an id or without words all stay.
    """
    sketches, placed = _placed(docs, id_col, text_col, size, percent)
    rows = sketches.filter("id is not null and digest is not null").select("id", "stamp", "digest")
    grouped = salted_join(rows, placed, "digest", "id")
    gone = grouped.filter("id != head.id or stamp != head.stamp").select("id", "stamp").distinct()
    kept = docs.join(gone, _same_row(docs, gone, id_col, text_col), "left_anti")
    again = rows.groupBy("id", "stamp").agg(F.count("*").alias("n")).filter("n > 1")
    again = materialize(again.select("id", "stamp"), "again")
    if again.isEmpty():
        return kept
    again = broadcast_if_small(again, SMALL_IDS)
    same = _same_row(docs, again, id_col, text_col)
    once = kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, same, "left_anti").union(once)


def _same_row(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> Column:
    """Whether a row of ``docs`` is the one ``keys`` (id, stamp) names."""
    return (docs[id_col] == keys["id"]) & (F.xxhash64(docs[text_col]) == keys["stamp"])
