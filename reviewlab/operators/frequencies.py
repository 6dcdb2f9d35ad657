"""Value counts as the shared intermediate of every statistic.

A column of lengths, ratings or activity counts has few distinct values however
many rows it has. Counting the values first is one map-side-combined shuffle;
means, deviations, exact percentiles and histograms then read only the distinct
values, so no reducer ever receives a histogram from every task of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlab.schema import label_table


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """``(col, n)`` over non-null values, with ``share`` of the non-null rows on request."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("n").alias("total"))
    # One row by construction, hence the broadcast.
    return counts.crossJoin(F.broadcast(total)).select(
        col, "n", (F.col("n") / F.col("total")).alias("share")
    )


def complete_domain(counts: DataFrame, col: str = "sentiment", n: str = "n") -> DataFrame:
    """One row per label, 0 where the counts have none."""
    return (
        label_table(counts.sparkSession, col)
        .join(counts, col, "left")
        .select(col, F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n))
    )


def class_counts(df: DataFrame, label: str = "sentiment") -> DataFrame:
    """Rows per label of the domain, with the smallest present class alongside."""
    full = complete_domain(value_counts(df, label), label)
    smallest = full.filter("n > 0").agg(F.min("n").alias("smallest_class"))
    return full.crossJoin(F.broadcast(smallest))


def numeric_frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(name, value, n)`` for several numeric columns in one scan. NaN counts as null."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value"),
            )
            for c in cols
        ]
    )
    return (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weighted_percentile(value: str, p: float, n: str = "n") -> Column:
    """Exact, linearly interpolated percentile of a frequency table."""
    return F.percentile(value, p, F.col(n))


def describe_frequencies(freq: DataFrame, ps: list[float]) -> DataFrame:
    """count, mean, sample deviation, min, percentiles and max for each ``name``."""
    center = freq.groupBy("name").agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean")
    )
    # Two passes over the distinct values: the textbook sum-of-squares form cancels.
    return (
        freq.join(F.broadcast(center), "name")
        .groupBy("name")
        .agg(
            F.sum("n").alias("count"),
            F.first("mean").alias("mean"),
            F.sqrt(
                F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2))
                / F.nullif(F.sum("n") - 1, F.lit(0))
            ).alias("std"),
            F.min("value").alias("min"),
            *[weighted_percentile("value", p).alias(f"p{p * 100:g}") for p in ps],
            F.max("value").alias("max"),
        )
    )


def iqr_from_frequencies(freq: DataFrame, k: float = 1.5) -> DataFrame:
    """One row: quartiles, the outlier bounds (the lower never below 0) and how many
    rows fall outside them."""
    quartiles = freq.agg(
        weighted_percentile("value", 0.25).alias("q1"),
        weighted_percentile("value", 0.75).alias("q3"),
    )
    bounds = quartiles.select(
        "q1",
        "q3",
        F.greatest(F.lit(0.0), F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"),
    )
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return (
        freq.crossJoin(F.broadcast(bounds))
        .groupBy("q1", "q3", "lower", "upper")
        .agg(F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers"))
    )


def histogram_from_frequencies(freq: DataFrame, bins: int) -> DataFrame:
    """``(bin, lower, upper, n)`` for equal-width bins from min to max, the last one
    closed; a constant column gets bins over +-0.5. Empty bins are kept."""
    if bins < 1:
        raise ValueError("bins must be positive")
    span = freq.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / bins

    def edge(i: Column) -> Column:
        return i * step + F.col("lo")

    guess = F.least(
        F.floor((F.col("value") - F.col("lo")) / step).cast("int"), F.lit(bins - 1)
    )
    # A division can land on the wrong side of an edge; the edges decide.
    settled = (
        F.when(F.col("value") < edge(F.col("g")), F.col("g") - 1)
        .when(
            (F.col("value") >= edge(F.col("g") + 1)) & (F.col("g") < bins - 1), F.col("g") + 1
        )
        .otherwise(F.col("g"))
    )
    counts = (
        freq.crossJoin(F.broadcast(span))
        .withColumn("g", guess)
        .select(settled.cast("int").alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    every = freq.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.crossJoin(F.broadcast(span))
        .join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("lower"),
            edge(F.col("bin") + 1).alias("upper"),
            F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
        )
    )
