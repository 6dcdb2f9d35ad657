"""Ratings adjusted by the sentiment of the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlab.functions.labels import RATING_MAX, RATING_MIN, clip, rating_adjustment, to_number
from reviewlab.functions.text import strip
from reviewlab.operators.frequencies import value_counts
from reviewlab.schema import require_columns


def adjust_ratings(
    df: DataFrame, row_id: str = "review_id", rule: dict[str, float] | None = None,
    lo: float = RATING_MIN, hi: float = RATING_MAX,
) -> DataFrame:
    """``(review_id, review_text, original_rating, sentiment_label, adjustment,
    adjusted_rating)``; rows without rating or label are dropped."""
    require_columns(df, ["overall", "sentiment", "text", row_id])
    rated = df.select(
        F.col(row_id).alias("review_id"),
        F.col("text").alias("review_text"),
        to_number("overall").alias("original_rating"),
        strip("sentiment").alias("sentiment_label"),
    ).na.drop(subset=["original_rating", "sentiment_label"])
    return rated.withColumn("adjustment", rating_adjustment("sentiment_label", rule)).withColumn(
        "adjusted_rating", clip(F.col("original_rating") + F.col("adjustment"), lo, hi)
    )


def rating_adjustment_summary(adjusted: DataFrame, digits: int = 4) -> DataFrame:
    """One row: how many, mean before and after, range after, rows per label."""
    per_label = value_counts(adjusted, "sentiment_label").agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("sentiment_label", "n")))
        ).alias("sentiment_counts")
    )
    return adjusted.agg(
        F.count(F.lit(1)).alias("total_reviews_processed"),
        F.round(F.avg("original_rating"), digits).alias("mean_original_rating"),
        F.round(F.avg("adjusted_rating"), digits).alias("mean_adjusted_rating"),
        F.round(F.min("adjusted_rating"), digits).alias("min_adjusted_rating"),
        F.round(F.max("adjusted_rating"), digits).alias("max_adjusted_rating"),
    ).crossJoin(F.broadcast(per_label))
