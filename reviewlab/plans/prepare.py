"""From raw reviews to labelled, cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from reviewlab.functions.labels import label_sentiment, to_number
from reviewlab.functions.text import build_text, clean_text, text_lengths
from reviewlab.schema import require_columns, select_existing

# The columns of the labelled table, in order.
LABELED_COLUMNS = [
    "review_id",
    "overall",
    "sentiment",
    "text",
    "text_raw",
    "word_len",
    "char_len",
    "asin",
    "reviewerID",
    "unixReviewTime",
]


def drop_invalid(df: DataFrame, cols: list[str], text: str | None = None) -> DataFrame:
    """Drop rows with a null in ``cols``, and rows whose ``text`` is empty."""
    rows = df.na.drop(subset=cols)
    return rows.filter(F.length(text) > 0) if text else rows


class RunCounts:
    """Counts of a preparation, collected by the job that writes its rows: the rows loaded, with
    a valid label, and left. A map-only write counts each partition once, also when tasks are
    repeated; read the counts after it."""

    def __init__(self) -> None:
        self.loaded, self.left = Observation(), Observation()

    def get(self) -> dict[str, int]:
        seen = {**self.loaded.get, **self.left.get}
        names = ("rows_loaded", "rows_labelled", "rows_with_text")
        return {name: int(seen.get(name) or 0) for name in names}


def prepare_reviews(
    raw: DataFrame, key: str = "review_id", counts: RunCounts | None = None
) -> DataFrame:
    """Label, combine and clean the text, measure it, and keep the columns that exist.

    Rows without a valid rating or without text are dropped. All of it is row-local. ``counts``
    gathers how many rows each step left while the result is written, without a pass of its own.
    """
    require_columns(raw, ["overall", key])
    labelled = raw.withColumns(
        {"sentiment": label_sentiment("overall"), "overall": to_number("overall")}
    )
    if counts:
        valid = F.col("overall").isNotNull() & F.col("sentiment").isNotNull()
        labelled = labelled.observe(
            counts.loaded,
            F.count(F.lit(1)).alias("rows_loaded"),
            F.count_if(valid).alias("rows_labelled"),
        )
    labelled = drop_invalid(labelled, ["overall", "sentiment"])
    cleaned = labelled.withColumn("text_raw", build_text(labelled)).withColumn(
        "text", clean_text("text_raw")
    )
    measured = text_lengths(drop_invalid(cleaned, ["text"], "text"))
    rows = select_existing(measured.withColumnRenamed(key, "review_id"), LABELED_COLUMNS)
    return rows.observe(counts.left, F.count(F.lit(1)).alias("rows_with_text")) if counts else rows
