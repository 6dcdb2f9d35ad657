"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows in one Arrow batch. Texts differ in length by four orders of magnitude, so the
#: batches handed to Python are kept short.
BATCH_ROWS = 256


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Hand Python workers at most ``rows`` rows at a time in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the planner inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def map_rows(
    df: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], schema: T.StructType
) -> DataFrame:
    """Run ``work`` over the Arrow batches of every partition.

    ``work`` takes and yields column mappings (name to Arrow array or list); it starts once
    per partition, so what it sets up serves all batches of the task.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns():
            for batch in batches:
                yield dict(zip(batch.schema.names, batch.columns))

        for out in work(columns()):
            arrays = [
                out[f.name].cast(f.type)
                if isinstance(out[f.name], (pa.Array, pa.ChunkedArray))
                else pa.array(out[f.name], f.type)
                for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def fields(df: DataFrame, *names: str) -> list[T.StructField]:
    """The named columns' fields, nullable."""
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
