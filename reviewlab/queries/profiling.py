"""Profiling queries: counts, percentiles, activity, time, duplicates, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import frequencies, profile
from reviewlab.queries import views as v
from reviewlab.queries.registry import query


@query(f"{v.with_views(v.REVIEWS)} SELECT overall, count(*) AS n FROM reviews GROUP BY overall")
def rating_distribution(spark, sf):
    return profile.rating_distribution(v.reviews(spark, sf))


@query(f"""{v.with_views(v.PRODUCT_REVIEWS)}
SELECT overall, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM product_reviews WHERE overall IS NOT NULL GROUP BY overall""")
def rating_shares(spark, sf):
    shares = frequencies.value_counts(v.product_reviews(spark, sf), "overall", normalize=True)
    return shares.withColumn("share", F.round("share", 6))


@query(f"""{v.with_views(v.REVIEWS, v.DOMAIN)}
SELECT d.label AS sentiment, count(r.review_id) AS n
FROM domain d LEFT JOIN reviews r ON r.sentiment = d.label GROUP BY d.label""")
def sentiment_counts(spark, sf):
    return profile.label_distribution(v.labelled_reviews(spark, sf))


@query(f"""{v.with_views(v.LABELED_DOCS, v.DOMAIN)},
c AS (SELECT d.label AS sentiment, count(r.review_id) AS n
      FROM domain d LEFT JOIN labeled_docs r ON r.sentiment = d.label GROUP BY d.label)
SELECT *, (SELECT min(n) FROM c WHERE n > 0) AS smallest_class FROM c""")
def class_counts(spark, sf):
    return frequencies.class_counts(v.labeled_docs(spark, sf))


def _activity_sql(view: str, name: str, key: str) -> str:
    return f"""{v.with_views(view)},
c AS (SELECT {key} AS k, count(*) AS n FROM {name} WHERE {key} IS NOT NULL GROUP BY 1)
SELECT count(*) AS keys, round(avg(n), 6) AS mean, CAST(median(n) AS DOUBLE) AS median,
       CAST(max(n) AS BIGINT) AS max FROM c"""


@query(_activity_sql(v.PRODUCT_REVIEWS, "product_reviews", "asin"))
def activity_per_product(spark, sf):
    df = profile.activity_per_key(v.product_reviews(spark, sf), "asin")
    return df.withColumn("mean", F.round("mean", 6))


@query(_activity_sql(v.REVIEWS, "reviews", '"reviewerID"'))
def activity_per_user(spark, sf):
    df = profile.activity_per_key(v.reviews(spark, sf), "reviewerID")
    return df.withColumn("mean", F.round("mean", 6))


@query(f"""{v.with_views(v.REVIEWS)}
SELECT count(DISTINCT asin) AS unique_asin, count(DISTINCT "reviewerID") AS "unique_reviewerID"
FROM reviews""")
def unique_counts(spark, sf):
    return profile.unique_counts(v.reviews(spark, sf), ["asin", "reviewerID"])


@query(f"""{v.with_views(v.PRODUCT_REVIEWS)}
SELECT round(coalesce(avg(overall), 0), 4) AS average_rating,
       round(coalesce(median(overall), 0), 4) AS median_rating FROM product_reviews""")
def rating_center(spark, sf):
    return profile.rating_center(v.product_reviews(spark, sf))


def _describe_sql(col: str) -> str:
    ps = ", ".join(
        f"round(quantile_cont({col}, {p}), 4) AS p{p * 100:g}" for p in profile.PERCENTILES
    )
    return (
        f"SELECT '{col}' AS name, count({col}) AS count, round(avg({col}), 4) AS mean, "
        f"round(stddev_samp({col}), 4) AS std, CAST(min({col}) AS DOUBLE) AS min, {ps}, "
        f"CAST(max({col}) AS DOUBLE) AS max FROM docs"
    )


@query(
    f"{v.with_views(v.DOCS)} {_describe_sql('char_len')} UNION ALL {_describe_sql('word_len')}"
)
def describe_lengths(spark, sf):
    df = profile.describe_lengths(v.measured_docs(spark, sf))
    kept = {"name", "count", "min", "max"}
    return df.select(*[c if c in kept else F.round(c, 4).alias(c) for c in df.columns])


_BOUNDS_SQL = """q AS (SELECT quantile_cont(word_len, 0.25) AS q1, quantile_cont(word_len, 0.75) AS q3
       FROM docs),
b AS (SELECT q1, q3, greatest(0, q1 - 1.5 * (q3 - q1)) AS lower, q3 + 1.5 * (q3 - q1) AS upper
      FROM q)"""


@query(f"""{v.with_views(v.DOCS, _BOUNDS_SQL)}
SELECT review_id, word_len FROM docs, b WHERE word_len < lower OR word_len > upper""")
def length_outliers(spark, sf):
    df = profile.length_outliers(v.measured_docs(spark, sf), "word_len")
    return df.select("review_id", "word_len")


@query(f"""{v.with_views(v.DOCS, _BOUNDS_SQL)}
SELECT CAST(q1 AS DOUBLE) AS q1, CAST(q3 AS DOUBLE) AS q3, CAST(lower AS DOUBLE) AS lower,
       CAST(upper AS DOUBLE) AS upper,
       (SELECT count(*) FROM docs, b WHERE word_len < lower OR word_len > upper) AS outliers
FROM b""")
def iqr_bounds(spark, sf):
    return profile.iqr_bounds(v.measured_docs(spark, sf), "word_len")


@query(f"""{v.with_views(v.DOCS)},
g AS (SELECT count(*) AS n FROM docs GROUP BY {v.squeeze_sql('lower(text)')})
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM g""")
def duplicate_texts(spark, sf):
    return profile.duplicate_text_count(v.docs(spark, sf))


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, row_number() OVER (PARTITION BY {v.squeeze_sql('lower(text)')}
                                     ORDER BY review_id) > 1 AS is_duplicate
FROM docs""")
def flag_duplicates(spark, sf):
    normal = v.docs(spark, sf).select(
        "review_id", profile.normalize_ws("text").alias("text_norm")
    )
    return profile.flag_duplicates(normal, ["text_norm"], "review_id").drop("text_norm")


@query(f"""{v.with_views(v.REVIEWS)},
g AS (SELECT count(*) AS n FROM reviews GROUP BY "reviewerID", asin, overall)
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM g""")
def exact_duplicates(spark, sf):
    return profile.exact_duplicate_count(v.reviews(spark, sf))


@query(f"""{v.with_views(v.DOCS)},
t AS (SELECT {v.squeeze_sql('lower(text)')} AS text_norm FROM docs)
SELECT text_norm, count(*) AS n FROM t WHERE text_norm <> '' GROUP BY text_norm
ORDER BY n DESC, sha256(text_norm) LIMIT 10""")
def top_repeated_texts(spark, sf):
    return profile.top_repeated_texts(v.docs(spark, sf), row_id="review_id")


@query(f"""{v.with_views(v.PRODUCT_REVIEWS)}
SELECT verified, count(overall) AS count, round(avg(overall), 6) AS mean,
       median(overall) AS median
FROM product_reviews WHERE verified IS NOT NULL GROUP BY verified""")
def rating_by_verified(spark, sf):
    df = profile.rating_by_flag(v.product_reviews(spark, sf))
    return df.withColumn("mean", F.round("mean", 6))


@query(f"""{v.with_views(v.REVIEWS)}
SELECT strftime(date_trunc('month', make_timestamp("unixReviewTime" * 1000000)), '%Y-%m-%d')
         AS month, count(*) AS n
FROM reviews GROUP BY 1""")
def reviews_by_month(spark, sf):
    df = profile.reviews_by_month(v.reviews(spark, sf))
    return df.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query(f"""{v.with_views(v.REVIEWS)}
SELECT CAST(month(make_timestamp("unixReviewTime" * 1000000)) AS INTEGER) AS month_of_year,
       count(*) AS n
FROM reviews GROUP BY 1""")
def seasonality(spark, sf):
    return profile.seasonality(v.reviews(spark, sf))


@query(f"""{v.with_views(v.REVIEWS)},
c AS (SELECT count(*) AS n FROM reviews GROUP BY "reviewerID")
SELECT round(avg(CASE WHEN n = 1 THEN 1.0e0 ELSE 0 END), 6) AS single_share,
       round(avg(CASE WHEN n > 10 THEN 1.0e0 ELSE 0 END), 6) AS power_share FROM c""")
def user_segments(spark, sf):
    df = profile.user_segments(v.reviews(spark, sf))
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


def _histogram_sql(views: str, values: str, bins: int) -> str:
    # The bin of a value is the last one whose lower edge it reaches.
    return f"""{views},
val AS ({values}),
span AS (SELECT CAST(min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS DOUBLE) AS lo,
                CAST(max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS DOUBLE) AS hi
         FROM val),
edges AS (SELECT CAST(i AS INTEGER) AS bin, i * ((hi - lo) / {bins}) + lo AS lower,
                 (i + 1) * ((hi - lo) / {bins}) + lo AS upper FROM range({bins}) r(i), span),
hits AS (SELECT x, max(bin) AS bin FROM (SELECT DISTINCT x FROM val) d, edges
         WHERE x >= lower GROUP BY x),
n AS (SELECT h.bin, count(*) AS n FROM val JOIN hits h USING (x) GROUP BY h.bin)
SELECT e.bin, round(lower, 6) AS lower, round(upper, 6) AS upper, coalesce(n.n, 0) AS n
FROM edges e LEFT JOIN n ON n.bin = e.bin"""


def _rounded_edges(df):
    return df.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query(_histogram_sql(v.with_views(v.DOCS), "SELECT word_len AS x FROM docs", 60))
def hist_word_len(spark, sf):
    return _rounded_edges(profile.histogram(v.measured_docs(spark, sf), "word_len", 60))


@query(_histogram_sql(v.with_views(v.DOCS), "SELECT char_len AS x FROM docs", 60))
def hist_char_len(spark, sf):
    return _rounded_edges(profile.histogram(v.measured_docs(spark, sf), "char_len", 60))


@query(
    _histogram_sql(
        v.with_views(v.REVIEWS), 'SELECT count(*) AS x FROM reviews GROUP BY "reviewerID"', 50
    )
)
def hist_per_user(spark, sf):
    return _rounded_edges(profile.activity_histogram(v.reviews(spark, sf), "reviewerID", 50))


@query(
    _histogram_sql(
        v.with_views(v.PRODUCT_REVIEWS),
        "SELECT count(*) AS x FROM product_reviews GROUP BY asin",
        50,
    )
)
def hist_per_product(spark, sf):
    return _rounded_edges(profile.activity_histogram(v.product_reviews(spark, sf), "asin", 50))


@query(f"""{v.with_views(v.REVIEWS)},
c AS (SELECT "reviewerID", sentiment, count(*) AS k FROM reviews GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY "reviewerID" ORDER BY k DESC, sentiment) AS rn,
             sum(k) OVER (PARTITION BY "reviewerID") AS total FROM c)
SELECT "reviewerID", sentiment, CAST(total AS BIGINT) AS n FROM r WHERE rn = 1""")
def majority_label(spark, sf):
    return profile.majority_label(v.labelled_reviews(spark, sf), "reviewerID")


@query(f"""{v.with_views(v.DOCS)},
f AS (SELECT CAST(review_id % 5 + 1 AS DOUBLE) AS overall, text FROM docs
  UNION ALL
  SELECT CASE review_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 2.5e0 ELSE 4e0 END,
    CASE WHEN review_id % 2 = 0 THEN '' ELSE text END FROM docs),
l AS (SELECT {v.label_sql('overall')} AS sentiment, {v.clean_sql('text')} AS text FROM f),
u AS (SELECT *, sentiment IS NOT NULL AND length(text) > 0 AS usable FROM l)
SELECT count(*) AS rows_loaded, count(sentiment) AS rows_labelled,
       count(*) FILTER (usable) AS rows_with_text,
       count(*) FILTER (usable AND sentiment = 'Positive') AS n_positive,
       count(*) FILTER (usable AND sentiment = 'Neutral') AS n_neutral,
       count(*) FILTER (usable AND sentiment = 'Negative') AS n_negative FROM u""")
def funnel(spark, sf):
    i, docs = F.col("review_id"), v.docs(spark, sf)
    rated = docs.select(
        (i % 5 + 1).cast("double").alias("overall"), F.col("text").alias("reviewText")
    )
    # Rows without a usable rating or text beside them.
    edges = docs.select(
        F.when(i % 3 == 0, None).when(i % 3 == 1, 2.5).otherwise(4.0).alias("overall"),
        F.when(i % 2 == 0, "").otherwise(F.col("text")).alias("reviewText"),
    )
    raw = rated.union(edges)
    return profile.funnel(raw)


@query(f"""{v.with_views(v.LABELED_DOCS)},
t AS (SELECT *, lang AS "reviewerID", CAST(len({v.split_words_sql('text')}) AS INTEGER) AS words,
             {v.squeeze_sql('lower(text)')} AS text_norm FROM labeled_docs),
p AS (SELECT asin, count(*) AS n FROM t GROUP BY asin),
u AS (SELECT "reviewerID", count(*) AS n FROM t GROUP BY "reviewerID"),
q AS (SELECT quantile_cont(words, 0.25) AS q1, quantile_cont(words, 0.75) AS q3 FROM t),
b AS (SELECT greatest(0, q1 - 1.5 * (q3 - q1)) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT count(*) AS subset_rows, count(DISTINCT asin) AS unique_products,
       count(DISTINCT "reviewerID") AS unique_users,
       round(avg(overall), 4) AS average_rating, round(median(overall), 4) AS median_rating,
       count(*) FILTER (sentiment = 'Positive') AS n_positive,
       count(*) FILTER (sentiment = 'Neutral') AS n_neutral,
       count(*) FILTER (sentiment = 'Negative') AS n_negative,
       count(*) FILTER (overall = 1) AS n_1, count(*) FILTER (overall = 3) AS n_3,
       count(*) FILTER (overall = 5) AS n_5,
       round(avg(words), 4) AS words_mean, round(median(words), 4) AS words_median,
       round(quantile_cont(words, 0.95), 4) AS words_p95,
       round(quantile_cont(words, 0.99), 4) AS words_p99,
       count(*) - count(DISTINCT text_norm) AS duplicate_normalized_text_count,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT "reviewerID", asin, overall, text FROM t))
         AS exact_duplicate_count,
       (SELECT round(avg(n), 4) FROM p) AS product_mean,
       (SELECT round(median(n), 4) FROM p) AS product_median, (SELECT max(n) FROM p) AS product_max,
       (SELECT round(avg(n), 4) FROM u) AS user_mean,
       (SELECT round(median(n), 4) FROM u) AS user_median, (SELECT max(n) FROM u) AS user_max,
       (SELECT round(CAST(lower AS DOUBLE), 4) FROM b) AS lower,
       (SELECT round(CAST(upper AS DOUBLE), 4) FROM b) AS upper,
       (SELECT count(*) FROM t, b WHERE words < lower OR words > upper) AS outlier_review_count
FROM t""")
def profile_report(spark, sf):
    labelled = v.labeled_docs(spark, sf).withColumn("reviewerID", F.col("lang"))
    report = profile.profile_report(labelled)

    def stars(key: str):
        return F.coalesce(
            F.try_element_at("rating_distribution", F.lit(key)), F.lit(0).cast("bigint")
        )

    return report.select(
        "subset_rows",
        "unique_products",
        "unique_users",
        "average_rating",
        "median_rating",
        F.col("sentiment_distribution.Positive").alias("n_positive"),
        F.col("sentiment_distribution.Neutral").alias("n_neutral"),
        F.col("sentiment_distribution.Negative").alias("n_negative"),
        stars("1.0").alias("n_1"),
        stars("3.0").alias("n_3"),
        stars("5.0").alias("n_5"),
        *[F.col(f"word_length_stats.{s}").alias(f"words_{s}")
          for s in ("mean", "median", "p95", "p99")],
        "duplicate_normalized_text_count",
        "exact_duplicate_count",
        *[F.col(f"reviews_per_{kind}.{s}").alias(f"{kind}_{s}")
          for kind in ("product", "user") for s in ("mean", "median", "max")],
        "outlier_thresholds_iqr.lower",
        "outlier_thresholds_iqr.upper",
        "outlier_review_count",
    )


@query(f"""{v.with_views(v.PRODUCT_REVIEWS)},
c AS (SELECT asin, count(*) AS reviews FROM product_reviews GROUP BY asin),
r AS (SELECT reviews, row_number() OVER (ORDER BY reviews DESC, asin) AS rn FROM c)
SELECT reviews, min(rn) AS first_rank, max(rn) AS last_rank FROM r GROUP BY reviews""")
def rank_curve(spark, sf):
    return profile.rank_curve(v.product_reviews(spark, sf), "asin")


@query(f"""{v.with_views(v.PRODUCT_REVIEWS)}
SELECT asin, count(*) AS n FROM product_reviews GROUP BY asin ORDER BY n DESC, asin LIMIT 20""")
def top_products(spark, sf):
    return profile.top_keys(v.product_reviews(spark, sf), "asin")


@query(f"""{v.with_views(v.REVIEWS)}
SELECT "reviewerID", count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20""")
def top_users(spark, sf):
    return profile.top_keys(v.reviews(spark, sf), "reviewerID")
