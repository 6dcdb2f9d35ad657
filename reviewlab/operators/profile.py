"""Exploratory profiling of a review table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from reviewlab.functions.labels import label_sentiment, review_calendar, to_number
from reviewlab.functions.text import (
    build_text,
    clean_text,
    normalize_ws,
    text_digest,
    word_count,
)
from reviewlab.operators.frequencies import (
    complete_domain,
    describe_frequencies,
    histogram_from_frequencies,
    iqr_from_frequencies,
    numeric_frequencies,
    value_counts,
    weighted_percentile,
)
from reviewlab.schema import LABELS, require_columns

PERCENTILES = [0.5, 0.75, 0.9, 0.95, 0.99]


# --- activity per product or user -------------------------------------------------


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """``(key, n)``; null keys are left out. A hot key is combined before the shuffle."""
    return value_counts(df, key)


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """``(value, n)``: how many keys have how many rows. Even 10^11 rows have under
    half a million distinct counts."""
    return (
        rows_per_key(df, key)
        .groupBy(F.col("n").alias("value"))
        .agg(F.count(F.lit(1)).alias("keys"))
        .select(F.col("value").cast("double").alias("value"), F.col("keys").alias("n"))
    )


def activity_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row: number of keys, and mean, median and maximum rows per key."""
    return count_of_counts(df, key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("keys"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        weighted_percentile("value", 0.5).alias("median"),
        F.max("value").cast("bigint").alias("max"),
    )


def user_segments(df: DataFrame, key: str = "reviewerID", power: int = 10) -> DataFrame:
    """Share of users with exactly one row, and with more than ``power``."""
    total = F.sum("n")
    return count_of_counts(df, key).agg(
        (F.sum(F.when(F.col("value") == 1, F.col("n")).otherwise(0)) / total).alias(
            "single_share"
        ),
        (F.sum(F.when(F.col("value") > power, F.col("n")).otherwise(0)) / total).alias(
            "power_share"
        ),
    )


def rank_curve(df: DataFrame, key: str) -> DataFrame:
    """Rows per key against rank, longest first, as one row per distinct count with
    the first and last rank it covers. Nothing is lost: equal counts are one step."""
    steps = count_of_counts(df, key)
    # The running total is over distinct counts, never over keys.
    w = Window.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum("n").over(w)
    return steps.select(
        F.col("value").cast("bigint").alias("reviews"),
        (last - F.col("n") + 1).alias("first_rank"),
        last.alias("last_rank"),
    )


def top_keys(df: DataFrame, key: str, k: int = 20) -> DataFrame:
    """The ``k`` keys with most rows; equal counts in key order."""
    return rows_per_key(df, key).orderBy(F.desc("n"), F.asc(key)).limit(k)


# --- ratings ------------------------------------------------------------------------


def unique_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, exact unless asked otherwise."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"unique_{c}") for c in cols])


def rating_center(df: DataFrame, col: str = "overall", digits: int = 4) -> DataFrame:
    """Mean and median, 0 when there is no rating."""
    freq = numeric_frequencies(df, [col])
    return freq.agg(
        F.round(
            F.coalesce(F.sum(F.col("value") * F.col("n")) / F.sum("n"), F.lit(0.0)), digits
        ).alias("average_rating"),
        F.round(F.coalesce(weighted_percentile("value", 0.5), F.lit(0.0)), digits).alias(
            "median_rating"
        ),
    )


def rating_by_flag(df: DataFrame, flag: str = "verified", rating: str = "overall") -> DataFrame:
    """Count, mean and median of the ratings per non-null flag. No flag, no rows."""
    counted = (
        df.filter(F.col(flag).isNotNull())
        .select(flag, F.nanvl(F.col(rating).cast("double"), F.lit(None)).alias("value"))
        .groupBy(flag, "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("n", F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(0))
    )
    return counted.groupBy(flag).agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("value") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        weighted_percentile("value", 0.5).alias("median"),
    )


def majority_label(
    df: DataFrame, key: str, label: str = "sentiment", labels: list[str] = LABELS
) -> DataFrame:
    """``(key, label, n)``: the most frequent label of each key, ties to the first in
    alphabetical order, and the labelled rows of the key.

    The labels are a known domain, so one combined shuffle of counters by key is enough.
    """
    order = sorted(labels)
    counted = (
        df.filter(F.col(label).isin(order))
        .groupBy(key)
        .agg(*[F.count_if(F.col(label) == name).alias(f"_c{i}") for i, name in enumerate(order)])
    )
    tallies = [F.col(f"_c{i}") for i in range(len(order))]
    best = F.greatest(*tallies) if len(order) > 1 else tallies[0]
    winner = F.lit(order[-1])
    for name, tally in reversed(list(zip(order, tallies))):
        winner = F.when(tally == best, F.lit(name)).otherwise(winner)
    return counted.select(key, winner.alias(label), sum(tallies[1:], tallies[0]).alias("n"))


# --- lengths --------------------------------------------------------------------------


def describe_lengths(
    df: DataFrame, cols: tuple[str, ...] = ("char_len", "word_len"), ps: list[float] = PERCENTILES
) -> DataFrame:
    return describe_frequencies(numeric_frequencies(df, list(cols)), ps)


def iqr_bounds(df: DataFrame, col: str = "word_len", k: float = 1.5) -> DataFrame:
    return iqr_from_frequencies(numeric_frequencies(df, [col]), k)


def length_outliers(df: DataFrame, col: str = "word_len", k: float = 1.5) -> DataFrame:
    """The rows outside the interquartile bounds of ``col``."""
    bounds = iqr_bounds(df, col, k).select("lower", "upper")
    outside = (F.col(col) < F.col("lower")) | (F.col(col) > F.col("upper"))
    return df.crossJoin(F.broadcast(bounds)).filter(outside).drop("lower", "upper")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    return histogram_from_frequencies(numeric_frequencies(df, [col]), bins)


def activity_histogram(df: DataFrame, key: str, bins: int = 50) -> DataFrame:
    """Histogram of the rows per key."""
    return histogram_from_frequencies(count_of_counts(df, key), bins)


# --- time ------------------------------------------------------------------------------


def reviews_by_month(df: DataFrame, seconds: str = "unixReviewTime") -> DataFrame:
    """Reviews per calendar month; months without any are absent."""
    return value_counts(review_calendar(df, seconds), "month")


def seasonality(df: DataFrame, seconds: str = "unixReviewTime") -> DataFrame:
    """Reviews per month of the year."""
    return value_counts(review_calendar(df, seconds), "month_of_year")


# --- duplicates -------------------------------------------------------------------------


def _row_digest(df: DataFrame, keys: list[str]) -> Column:
    """Digest of several columns; each value goes with its length, which keeps field ends
    and nulls apart."""
    values = [F.col(k).cast("string") for k in keys]
    parts = [
        F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in values
    ]
    return F.sha2(F.concat(*parts), 256)


def _repeats(digests: DataFrame) -> DataFrame:
    per_digest = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    return per_digest.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_text_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows after the first of each normalised text; empty texts repeat each other."""
    return _repeats(df.select(text_digest(normalize_ws(text)).alias("digest")))


def exact_duplicate_count(
    df: DataFrame, keys: tuple[str, ...] = ("reviewerID", "asin", "overall", "text")
) -> DataFrame:
    """Rows after the first of each combination of those keys that exist; 0 without any."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicates"))
    return _repeats(df.select(_row_digest(df, present).alias("digest")))


def flag_duplicates(df: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Add ``is_duplicate``: false on the first row of each key combination by ``row_id``.

    The first ids come from an aggregate that combines before its shuffle, and they
    are joined back on the unique id, so a text copied a billion times is never
    gathered in one task as a window over the text would do.
    """
    firsts = (
        df.select(_row_digest(df, keys).alias("digest"), row_id)
        .groupBy("digest")
        .agg(F.min(row_id).alias(row_id))
        .select(row_id, F.lit(False).alias("is_duplicate"))
    )
    return df.join(firsts, row_id, "left").withColumn(
        "is_duplicate", F.coalesce(F.col("is_duplicate"), F.lit(True))
    )


def top_repeated_texts(
    df: DataFrame, text: str = "text", k: int = 10, row_id: str | None = None
) -> DataFrame:
    """The ``k`` most frequent non-empty normalised texts ``(text_norm, n)``; equal counts
    in digest order. Only digests are shuffled; the winning texts are read back.

    With ``row_id`` each digest carries one id, so all texts are normalised once and then only
    the rows of ``k`` ids; an id may be null or repeat. Without it they are normalised twice.
    """
    carried = [row_id] if row_id else []
    normal = df.select(normalize_ws(text).alias("text_norm"), *carried).filter("text_norm <> ''")
    keyed = normal.withColumn("digest", text_digest("text_norm"))
    winners = (
        keyed.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias("_row") for c in carried])
        .orderBy(F.desc("n"), F.asc("digest"))
        .limit(k)
    )
    if row_id:
        # The digest is compared after the join: as a part of its key it would be computed for
        # every row of the table.
        found = df.select(F.col(row_id).alias("_id"), F.col(text).alias("_text")).join(
            F.broadcast(winners), F.col("_id").eqNullSafe(F.col("_row"))
        )
        norm = normalize_ws("_text")
        own = F.when(text_digest(norm) == F.col("digest"), norm)
        return found.groupBy("digest", "n").agg(F.max(own).alias("text_norm")).select("text_norm", "n")
    # k rows: broadcast is safe. One text per digest and task reaches the shuffle.
    return (
        keyed.join(F.broadcast(winners), "digest")
        .groupBy("digest", "text_norm", "n")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("text_norm", "n")
    )


# --- whole-table reports ------------------------------------------------------------------


def funnel(raw: DataFrame, rating: str = "overall") -> DataFrame:
    """One row: rows loaded, with a valid label, with text left, and the label counts of
    the last. One pass over the raw rows."""
    require_columns(raw, [rating])
    labelled = F.col("sentiment").isNotNull()
    usable = labelled & (F.length("text") > 0)
    flagged = raw.select(
        label_sentiment(rating).alias("sentiment"), clean_text(build_text(raw)).alias("text")
    )
    return flagged.agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.count_if(labelled).alias("rows_labelled"),
        F.count_if(usable).alias("rows_with_text"),
        *[
            F.count_if(usable & (F.col("sentiment") == label)).alias(f"n_{label.lower()}")
            for label in LABELS
        ],
    )


def subset_report(subset: DataFrame, counts: dict[str, int]) -> DataFrame:
    """``(measure, value, n)``: ``counts`` of the run so far, the rows of the subset, and its
    rows per sentiment and per rating. Labels and ratings are rows, so they may be any number;
    a null one has a null ``value``, and an empty subset has only the counts."""
    run = subset.sparkSession.createDataFrame(
        [(name, None, n) for name, n in counts.items()], "measure string, value string, n long"
    )
    none = F.lit(None).cast("string")
    rows = subset.agg(F.count(F.lit(1)).alias("n"))
    parts = [
        F.struct(F.lit(name).alias("measure"), F.col(column).cast("string").alias("value"))
        for name, column in (("sentiment", "sentiment"), ("rating", "overall"))
    ]
    shares = subset.select(F.inline(F.array(*parts))).groupBy("measure", "value")
    return (
        run.unionByName(rows.select(F.lit("subset_rows").alias("measure"), none.alias("value"), "n"))
        .unionByName(shares.agg(F.count(F.lit(1)).alias("n")))
    )


_VALUE_KINDS = ["rating", "sentiment", "words"]


def profile_report(df: DataFrame, k: float = 1.5, digits: int = 4) -> DataFrame:
    """One nested row with the whole profile of a labelled table.

    Every statistic is a statistic of counts, so all of them come from one scan and
    one combined shuffle of ``(kind, key)`` pairs; the rest runs on counts of counts.
    """
    require_columns(df, ["overall", "sentiment", "text"])
    words = F.col("word_len") if "word_len" in df.columns else word_count("text")
    exact = [c for c in ["reviewerID", "asin", "overall", "text"] if c in df.columns]

    keyed = {
        "rating": F.col("overall").cast("double").cast("string"),
        "sentiment": F.col("sentiment"),
        "words": words.cast("string"),
        "text": text_digest(normalize_ws("text")),
        "exact": _row_digest(df, exact),
    }
    for kind, col in (("product", "asin"), ("user", "reviewerID")):
        if col in df.columns:
            keyed[kind] = F.col(col).cast("string")

    pairs = F.array(
        *[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keyed.items()]
    )
    counts = (
        df.select(F.inline(pairs))
        .filter(F.col("key").isNotNull())
        .groupBy("kind", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_value = F.col("kind").isin(_VALUE_KINDS)
    freq = counts.groupBy(
        "kind",
        F.when(by_value, F.col("key")).otherwise(F.col("n").cast("string")).alias("key"),
    ).agg(F.sum(F.when(by_value, F.col("n")).otherwise(1)).alias("n"))
    freq = freq.withColumn("value", F.col("key").try_cast("double"))
    bounds = iqr_from_frequencies(freq.filter("kind = 'words'"), k)

    def of(kind: str, value: Column | None = None) -> Column:
        return F.when(F.col("kind") == kind, F.col("value") if value is None else value)

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(of(kind, F.col("n"))), F.lit(0))

    def mean(kind: str) -> Column:
        weighted = F.sum(of(kind, F.col("value") * F.col("n")))
        return F.coalesce(weighted / F.sum(of(kind, F.col("n"))), F.lit(0.0))

    def pct(kind: str, p: float) -> Column:
        # A null value carries no weight, whatever its frequency.
        return F.coalesce(F.percentile(of(kind), p, F.col("n")), F.lit(0.0))

    def repeats(kind: str) -> Column:
        return F.coalesce(
            F.sum(of(kind, (F.col("value") - 1) * F.col("n"))).cast("bigint"), F.lit(0)
        )

    def activity(kind: str) -> Column:
        return F.struct(
            F.round(mean(kind), digits).alias("mean"),
            F.round(pct(kind, 0.5), digits).alias("median"),
            F.coalesce(F.max(of(kind)).cast("bigint"), F.lit(0)).alias("max"),
        )

    report = freq.agg(
        # Every row has an exact key, so keys times their count are the rows.
        F.coalesce(
            F.sum(of("exact", F.col("value") * F.col("n"))).cast("bigint"), F.lit(0)
        ).alias("subset_rows"),
        total("product").alias("unique_products"),
        total("user").alias("unique_users"),
        F.round(mean("rating"), digits).alias("average_rating"),
        F.round(pct("rating", 0.5), digits).alias("median_rating"),
        F.struct(
            *[
                F.coalesce(
                    F.sum(
                        F.when(
                            (F.col("kind") == "sentiment") & (F.col("key") == label), F.col("n")
                        )
                    ),
                    F.lit(0),
                ).alias(label)
                for label in LABELS
            ]
        ).alias("sentiment_distribution"),
        F.map_from_entries(
            F.sort_array(F.collect_list(of("rating", F.struct("key", "n"))))
        ).alias("rating_distribution"),
        F.struct(
            F.round(mean("words"), digits).alias("mean"),
            F.round(pct("words", 0.5), digits).alias("median"),
            F.round(pct("words", 0.95), digits).alias("p95"),
            F.round(pct("words", 0.99), digits).alias("p99"),
        ).alias("word_length_stats"),
        repeats("text").alias("duplicate_normalized_text_count"),
        repeats("exact").alias("exact_duplicate_count"),
        activity("product").alias("reviews_per_product"),
        activity("user").alias("reviews_per_user"),
    )
    outside = bounds.select(
        F.struct(
            F.round("lower", digits).alias("lower"), F.round("upper", digits).alias("upper")
        ).alias("outlier_thresholds_iqr"),
        F.col("outliers").alias("outlier_review_count"),
    )
    # Two single rows; an empty table has no bounds row and reports zeros.
    joined = report.join(F.broadcast(outside), F.lit(True), "left")
    zero = F.lit(0.0)
    bounds_of = F.col("outlier_thresholds_iqr")
    return joined.withColumns(
        {
            "outlier_thresholds_iqr": F.struct(
                *[F.coalesce(bounds_of[e], zero).alias(e) for e in ("lower", "upper")]
            ),
            "outlier_review_count": F.coalesce("outlier_review_count", F.lit(0)),
        }
    )


def label_distribution(df: DataFrame, label: str = "sentiment") -> DataFrame:
    return complete_domain(value_counts(df, label), label)


def rating_distribution(df: DataFrame, rating: str = "overall") -> DataFrame:
    return value_counts(df.select(to_number(rating).alias(rating)), rating)
