"""Stage tables, reports, features and models on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reviewlab.session import scratch_root


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Write a stage table: Parquet between stages, CSV with a header for people.

    CSV cannot tell an empty text from a missing one; both read back as missing.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_stage(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Read a stage table. CSV needs its schema: nothing is inferred.

    Texts may hold line ends, so a CSV file is one task; ``multiline=False`` lets large
    files without them be split.
    """
    reader = spark.read
    if fmt == "csv":
        if schema is None:
            raise ValueError("reading CSV needs a schema")
        reader = reader.options(header=True, escape='"', multiLine=multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage table that its owner needs no more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str = "stage", vectors: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, which cuts its lineage
    and survives the loss of executors. The columns in ``vectors`` hold the structs vectors
    are stored as, and come back as vectors."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(_with_vectors(df.schema, vectors)).parquet(path)


@contextmanager
def stored(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``df`` as a stage table that is deleted at the end of the block, also after an error."""
    path = stage_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_stage(df.sparkSession, path)


def _with_vectors(schema: T.StructType, vectors: Sequence[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.name, VectorUDT() if f.name in vectors else f.dataType, f.nullable)
            for f in schema.fields
        ]
    )


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Mark a table for broadcast after counting at most ``max_rows`` + 1 of its rows; a
    larger one is returned as it is and joined by shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over the cores when the scan offers fewer tasks than there are cores.

    A small or unsplittable file would otherwise send all text work to one task. A scan
    with enough splits is returned as it is, so large inputs are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.select(key).rdd.getNumPartitions()
    return df if tasks >= cores else df.repartition(cores, key)


def write_summary(df: DataFrame, path: str) -> None:
    """Write a one-row report as JSON."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_text(df: DataFrame, path: str, cols: list[str], headings: list[str]) -> None:
    """Write one text block per row: each column under its heading."""
    parts = []
    for heading, col in zip(headings, cols):
        parts += [F.lit(f"=== {heading} ===\n"), F.concat(F.col(col), F.lit("\n"))]
    df.select(F.concat_ws("\n", *parts).alias("value")).write.mode("overwrite").text(path)


# --- features ------------------------------------------------------------------------------


def write_features(df: DataFrame, path: str, row_id: str = "row_id") -> None:
    """Write ``(row_id, features)`` and any label columns as Parquet."""
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str, features: str = "features") -> DataFrame:
    """Read features; a vector written as its plain struct comes back as a vector."""
    stored = spark.read.parquet(path).schema
    return spark.read.schema(_with_vectors(stored, [features])).parquet(path)
