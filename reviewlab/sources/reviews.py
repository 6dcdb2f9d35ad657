"""Reading review files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.schema import CORRUPT, RAW_REVIEW


def scan_raw(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """JSON lines as text columns; a malformed line keeps only ``_corrupt_record``.

    Blank lines are ignored. Compressed files cannot be split, so ``partitions``
    spreads their rows after the read.
    """
    df = spark.read.schema(RAW_REVIEW).json(path)
    return df.repartition(partitions) if partitions else df


def scan_reviews(
    spark: SparkSession, path: str | list[str], limit: int | None = None,
    order: list[str] | None = None, partitions: int | None = None,
) -> DataFrame:
    """Reviews with malformed lines left out, typed, ids as strings.

    ``limit`` alone takes any rows; with ``order`` it takes the first ones.
    """
    good = scan_raw(spark, path, partitions).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    typed = good.withColumns(
        {
            "unixReviewTime": F.col("unixReviewTime").try_cast("bigint"),
            "verified": F.col("verified").try_cast("boolean"),
        }
    )
    if limit is None:
        return typed
    return typed.orderBy(*order).limit(limit) if order else typed.limit(limit)


def scan_quality(raw: DataFrame) -> DataFrame:
    """One row: good and malformed lines of a raw scan."""
    # Spark refuses to read the corrupt column alone, so a second one is touched.
    touched = F.count("overall")
    bad = F.col(CORRUPT).isNotNull()
    return raw.agg(
        F.count_if(~bad).alias("good_rows"), F.count_if(bad).alias("malformed_rows"),
        touched.alias("rated_rows"),
    )
