"""Label domain and read schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The sentiment domain, in report order.
POSITIVE, NEUTRAL, NEGATIVE = "Positive", "Neutral", "Negative"
LABELS = ["Positive", "Neutral", "Negative"]

#: Class index used by the classifiers: alphabetical, as label encoders number them.
CLASS_ORDER = sorted(LABELS)

CORRUPT = "_corrupt_record"

# Every field is read as text and converted by an expression. A wrongly typed
# value then becomes null in its own column instead of condemning the line.
RAW_REVIEW = T.StructType(
    [
        T.StructField("overall", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("reviewerID", T.StringType()),
        T.StructField("unixReviewTime", T.StringType()),
        T.StructField("vote", T.StringType()),
        T.StructField("verified", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Return ``df`` unchanged, or fail naming the columns it lacks. Runs no job."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select([c for c in cols if c in df.columns])


def label_table(spark: SparkSession, col: str = "sentiment") -> DataFrame:
    """The label domain as a three-row table."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in LABELS])).alias(col))
