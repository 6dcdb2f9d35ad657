"""Consecutive row numbers for tables that come without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from reviewlab.sources.stages import materialize

_POSITION_BITS = 33


def with_row_id(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """Add 0-based row numbers in ``order`` without gathering the rows in one task.

    Rows are range-partitioned and sorted; each keeps its partition and its position
    there. That table is written before the partition sizes are read from it: a lost
    task must not be able to move a row after it was counted. Prefer an existing key.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _POSITION_BITS))
        .withColumn("_pos", F.col("_at") - F.shiftleft("_part", _POSITION_BITS))
        .drop("_at")
    )
    placed = materialize(placed, "row-numbers")
    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )
