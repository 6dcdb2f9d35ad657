"""Hard negatives by vertical scans of decomposed vectors.

Rows are dealt to parts that hold their vectors column by column. Each anchor visits every part
and reads its columns in descending magnitude of its own components. What the unread columns
can still add lies between bounds from their least and greatest values; rows whose bounds
leave every window sought, or fall below rows already sure to be among the first, leave the
candidate bitmap. What is left when all columns are read has its exact integer score.

The first scan finds each anchor's positives, the second the negatives inside each positive's
window. Parts are bounded in bytes and anchors stream past them, so a task holds one part; the
few rows a part gives for an anchor are merged by Spark.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component
(also after scaling), take no part; a repeated row counts once, and rows that share an id but
differ are rows of their own; vectors of different lengths are not compared; empty vectors score
0; scores outside 64 bits count as the nearest 64-bit integer; an anchor without positives or
a positive without negatives gives no rows; an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from reviewlab.llm.common import map_rows
from reviewlab.sources.stages import materialize

#: Positives of an anchor, and negatives of a positive.
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 50, 95
#: What a component is multiplied by before it is rounded down.
SCALE = 256
#: Bytes of one part's columns, and rows a part is not cut below to occupy more cores.
PART_BYTES, LEAST_ROWS = 64_000_000, 4_096
#: Columns read between two looks at the bounds.
STEP = 8
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def prepare(rows: DataFrame, id_col: str, vector: str, label: Column | str, scale: int) -> DataFrame:
    """``(row, id, label, q)``: each row that takes part once, with its whole components."""
    wide = F.transform(vector, lambda x: x.cast("double") * scale)
    fit = F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # From 2**53 on doubles are whole numbers, and would not fit the integer of floor.
    whole = F.transform(
        "q", lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)
    )
    label = F.col(label) if isinstance(label, str) else label
    known = rows.select(F.col(id_col).alias("id"), label.cast("string").alias("label"), wide.alias("q"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & fit)
    once = known.withColumn("q", whole).distinct()
    return materialize(once.withColumn("row", F.monotonically_increasing_id()), "vectors")


def scan(
    columns: np.ndarray, ends: tuple[np.ndarray, np.ndarray], among: np.ndarray, ids: np.ndarray,
    anchor: np.ndarray, windows: list[tuple[int, int]], k: int,
) -> list[tuple[np.ndarray, list[int]]]:
    """For each window ``(least, most)`` of scores, the first ``k`` rows of ``among`` inside:
    their places and their scores, higher first, then by id."""
    low, high = ends
    sizes = np.abs(anchor) @ np.maximum(np.abs(low), np.abs(high)) if len(anchor) else 0.0
    if not sizes < float(1 << 53):
        return _wide(columns, among, ids, anchor, windows, k)
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    reach = np.stack((a * low[order], a * high[order]))
    # What the columns after the first t can add at least and at most.
    rest = [np.append(np.cumsum(x[::-1])[::-1], 0.0) for x in (reach.min(0), reach.max(0))]
    partial = np.zeros(len(among))
    whole = len(among) == columns.shape[1]
    for t in range(0, len(a), STEP):
        dims = order[t : t + STEP]
        read = columns[dims] if whole else columns[np.ix_(dims, among)]
        partial += a[t : t + STEP] @ read
        end = min(t + STEP, len(a))
        least, most = partial + rest[0][end], partial + rest[1][end]
        open_ = np.zeros(len(among), bool)
        for lo, hi in windows:
            may = (most >= lo) & (least <= hi)
            sure = least[may & (least >= lo) & (most <= hi)]
            if len(sure) > k:
                may &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
            open_ |= may
        if not open_.any():
            return [(among[:0], []) for _ in windows]
        if open_.sum() < 0.8 * len(open_):
            among, partial, whole = among[open_], partial[open_], False
    return [_first(among, partial, ids, lo, hi, k) for lo, hi in windows]


def _first(among, scores, ids, lo, hi, k) -> tuple[np.ndarray, list[int]]:
    inside = np.flatnonzero((scores >= lo) & (scores <= hi))
    if len(inside) > k:
        bar = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
        inside = inside[scores[inside] >= bar]
    best = inside[np.lexsort((ids[among[inside]], -scores[inside]))][:k]
    return among[best], [int(s) for s in scores[best]]


def _wide(columns, among, ids, anchor, windows, k) -> list[tuple[np.ndarray, list[int]]]:
    """The same by integers of any size, where sums could leave what doubles hold exactly."""
    a = [int(x) for x in anchor]
    scores = [sum(x * int(y) for x, y in zip(a, columns[:, i])) for i in among]
    scores = [min(max(s, LEAST), MOST) for s in scores]
    out = []
    for lo, hi in windows:
        inside = [i for i, s in enumerate(scores) if lo <= s <= hi]
        best = sorted(inside, key=lambda i: (-scores[i], ids[among[i]]))[:k]
        out.append((among[best], [scores[i] for i in best]))
    return out


class Part:
    """The rows of one part and one vector length, by label and column by column."""

    def __init__(self, pieces: list[tuple]):
        rows, ids, labels, q = (np.concatenate(x) for x in zip(*pieces))
        order = np.argsort(labels, kind="stable")
        self.rows, self.ids, self.labels = rows[order], ids[order], labels[order]
        self.columns = np.ascontiguousarray(q[order].T)
        self.ends = self.columns.min(1), self.columns.max(1)

    def same(self, label: str, row: int) -> np.ndarray:
        """Places of the other rows of the label."""
        a, b = np.searchsorted(self.labels, label, "left"), np.searchsorted(self.labels, label, "right")
        at = np.arange(a, b)
        return at[self.rows[a:b] != row]

    def different(self, label: str) -> np.ndarray:
        a, b = np.searchsorted(self.labels, label, "left"), np.searchsorted(self.labels, label, "right")
        return np.concatenate((np.arange(a), np.arange(b, len(self.rows))))


FOUND = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("anchor", "positive", "row", "id", "score")
    ]
)


def _visit(rows: DataFrame, anchors: DataFrame, parts: int, negatives: int | None, k: int,
           low: int, high: int) -> DataFrame:
    """``(anchor, positive, row, id, score)``: what each part gives for each anchor.

    ``negatives`` says how many; without it the ``k`` positives are sought.
    """
    wanted = "array<struct<row: bigint, score: bigint>>"
    none = F.lit(None).cast(wanted)
    names = ["part", "kind", "row", "id", "label", "q", "wanted"]
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    held = rows.select(part.alias("part"), F.lit(0).alias("kind"), "row", "id", "label", "q", none.alias("wanted"))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    asking = anchors.select("*", every, F.lit(1).alias("kind"))
    if negatives is None:
        asking = asking.withColumn("wanted", none)
    both = held.unionByName(asking.select(*names))
    dealt = both.repartitionById(parts, "part").sortWithinPartitions("part", "kind")

    def ask(blocks, batch, places, out) -> None:
        for i in places:
            row, label = batch["row"][i].as_py(), batch["label"][i].as_py()
            q = batch["q"][i].values.to_numpy()
            block = blocks.get(len(q))
            if block is None:
                continue
            if negatives is None:
                goals, windows, among = [row], [(LEAST, MOST)], block.same(label, row)
            else:
                goals = [(w["row"], w["score"]) for w in batch["wanted"][i].as_py()]
                windows = [(-(-low * s // 100), high * s // 100) for _, s in goals]
                goals = [g for (g, _), (lo, hi) in zip(goals, windows) if lo <= hi]
                windows = [w for w in windows if w[0] <= w[1]]
                among = block.different(label)
            if not windows or not len(among):
                continue
            got = scan(block.columns, block.ends, among, block.ids, q, windows, negatives or k)
            for goal, (at, scores) in zip(goals, got):
                out["anchor"] += [row] * len(at)
                out["positive"] += [goal] * len(at)
                out["row"] += block.rows[at].tolist()
                out["id"] += block.ids[at].tolist()
                out["score"] += scores

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        at, pieces, blocks = None, {}, {}
        for batch in batches:
            out = {n: [] for n in FOUND.names}
            kinds = np.stack((batch["part"].to_numpy(), batch["kind"].to_numpy()))
            cuts = np.flatnonzero((np.diff(kinds) != 0).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, kinds.shape[1]]):
                if b == a:
                    continue
                if kinds[0, a] != at:
                    at, pieces, blocks = kinds[0, a], {}, {}
                if kinds[1, a]:
                    if pieces:
                        blocks, pieces = {n: Part(p) for n, p in pieces.items()}, {}
                    ask(blocks, batch, range(a, b), out)
                    continue
                lengths = pa.compute.list_value_length(batch["q"].slice(a, b - a)).to_numpy()
                for n in np.unique(lengths):
                    own = pa.array(np.flatnonzero(lengths == n) + a)
                    vectors = batch["q"].take(own).flatten().to_numpy().reshape(len(own), n)
                    cells = (batch[c].take(own).to_numpy(zero_copy_only=False) for c in ("row", "id", "label"))
                    pieces.setdefault(int(n), []).append((*cells, vectors))
            yield out

    return map_rows(dealt, work, FOUND)


def _parts(rows: DataFrame) -> int:
    """Parts bounded in bytes; more of them while there are idle cores."""
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(1))).first()
    fit = max(1, PART_BYTES // (8 * max(1, width)))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // fit), min(2 * cores, -(-n // LEAST_ROWS)))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on ``id``. An anchor's positives are its first other rows of
    the label; a positive's negatives the first rows of other labels whose score lies between
    ``low`` and ``high`` hundredths of the positive's.
    """
    vectors = prepare(rows, id_col, vector, label, scale)
    parts = _parts(vectors)
    anchors = vectors.filter(is_anchor)

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    near = _visit(vectors, anchors, parts, None, positives, low, high)
    near = materialize(first(near, ["anchor"], positives), "positives")
    wanted = near.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct("row", "score")).alias("wanted")
    )
    asking = materialize(anchors.join(wanted, "row"), "anchors")
    found = first(
        _visit(vectors, asking, parts, negatives, positives, low, high), ["anchor", "positive"], negatives
    )
    named = near.select(
        "anchor",
        F.col("row").alias("positive"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    own = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(named, ["anchor", "positive"]).join(own, "anchor").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
