"""Storage queries: what is written to files reads back as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.operators import tfidf
from reviewlab.operators.profile import label_distribution
from reviewlab.queries import views as v
from reviewlab.queries.registry import query
from reviewlab.session import scratch_root
from reviewlab.sources import reviews as source
from reviewlab.sources import stages


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _json_lines(spark: SparkSession, sf: str) -> str:
    """The reviews as JSON lines, every 50th line cut short, plus blank lines."""
    df = v.reviews(spark, sf)
    line = F.to_json(
        F.struct(
            F.col("review_id").cast("string").alias("asin"),
            "reviewerID",
            "overall",
            "unixReviewTime",
            "verified",
            "vote",
        )
    )
    broken = F.when(F.col("review_id") % 50 == 7, F.substring(line, 1, 12)).otherwise(line)
    spaced = F.when(F.col("review_id") % 31 == 3, F.concat(broken, F.lit("\n"))).otherwise(broken)
    path = _folder(spark, "json-lines")
    df.select(spaced.alias("value")).write.text(path, compression="gzip")
    return path


@query(f"""{v.with_views(v.REVIEWS)}
SELECT CAST(review_id AS VARCHAR) AS asin, "reviewerID", CAST(overall AS VARCHAR) AS overall,
       "unixReviewTime", coalesce(CAST(verified AS VARCHAR), 'unknown') AS verified, vote
FROM reviews WHERE review_id % 50 <> 7""")
def scan_jsonl(spark, sf):
    """Good lines of a compressed JSON-lines file."""
    df = source.scan_reviews(spark, _json_lines(spark, sf), partitions=8)
    known = F.coalesce(F.col("verified").cast("string"), F.lit("unknown")).alias("verified")
    return df.select("asin", "reviewerID", "overall", "unixReviewTime", known, "vote")


@query(f"""{v.with_views(v.REVIEWS)}
SELECT count(*) FILTER (review_id % 50 <> 7) AS good_rows,
       count(*) FILTER (review_id % 50 = 7) AS malformed_rows,
       count(overall) FILTER (review_id % 50 <> 7) AS rated_rows FROM reviews""")
def scan_quality(spark, sf):
    raw = source.scan_raw(spark, _json_lines(spark, sf))
    return source.scan_quality(raw)


@query(f"""{v.with_views(v.REVIEWS)}
SELECT CAST(review_id AS VARCHAR) AS asin, CAST(overall AS VARCHAR) AS overall FROM reviews
WHERE review_id % 50 <> 7 ORDER BY 1 LIMIT 100""")
def scan_first(spark, sf):
    df = source.scan_reviews(spark, _json_lines(spark, sf), limit=100, order=["asin"])
    return df.select("asin", "overall")


@query(f"""{v.with_views(v.LABELED_DOCS)}
SELECT review_id, text, sentiment, overall FROM labeled_docs""")
def stage_roundtrip(spark, sf):
    """Through Parquet, then through CSV."""
    df = v.labeled_docs(spark, sf).select("review_id", "text", "sentiment", "overall")
    parquet, csv = _folder(spark, "stage"), _folder(spark, "stage-csv")
    stages.write_table(df, parquet, partition_by=["sentiment"])
    back = stages.read_stage(spark, parquet).select("review_id", "text", "sentiment", "overall")
    stages.write_table(back, csv, "csv")
    return stages.read_stage(
        spark, csv, "csv", "review_id bigint, text string, sentiment string, overall double"
    )


@query(f"""{v.with_views(v.REVIEWS)}
SELECT max(n) FILTER (sentiment = 'Positive') AS "Positive",
       max(n) FILTER (sentiment = 'Neutral') AS "Neutral",
       max(n) FILTER (sentiment = 'Negative') AS "Negative", sum(n)::BIGINT AS total
FROM (SELECT sentiment, count(*) AS n FROM reviews GROUP BY sentiment)""")
def summary_roundtrip(spark, sf):
    """A nested one-row report as JSON."""
    counts = label_distribution(v.labelled_reviews(spark, sf))
    report = counts.agg(
        F.struct(
            *[F.max(F.when(F.col("sentiment") == x, F.col("n"))).alias(x)
              for x in ("Positive", "Neutral", "Negative")]
        ).alias("sentiment_distribution"),
        F.sum("n").alias("total"),
    )
    path = _folder(spark, "summary")
    stages.write_summary(report, path)
    back = spark.read.schema(report.schema).json(path)
    return back.select("sentiment_distribution.*", "total")


def _indices(df: DataFrame) -> DataFrame:
    stored = F.unwrap_udt("features")
    return df.select(
        "review_id",
        F.size(stored["indices"]).cast("bigint").alias("terms"),
        F.round(F.sqrt(F.aggregate(stored["values"], F.lit(0.0), lambda a, x: a + x * x)), 6)
        .alias("norm"),
    )


@query(f"""{v.with_views(v.DOCS)},
tok AS (SELECT DISTINCT review_id, unnest(string_split({v.tokens_text_sql('text')}, ' ')) AS w
        FROM docs),
kept AS (SELECT * FROM tok WHERE length(w) >= 2),
cnt AS (SELECT w, count(*) AS df FROM kept GROUP BY w),
vocab AS (SELECT w FROM cnt WHERE df >= 2
          AND df <= 0.95 * (SELECT count(*) FROM docs WHERE {v.tokens_text_sql('text')} <> '')),
n AS (SELECT review_id, count(*) AS terms FROM kept WHERE w IN (SELECT w FROM vocab) GROUP BY 1)
SELECT d.review_id, coalesce(terms, 0) AS terms,
       CASE WHEN coalesce(terms, 0) > 0 THEN 1e0 ELSE 0e0 END AS norm
FROM docs d LEFT JOIN n ON n.review_id = d.review_id WHERE {v.tokens_text_sql('d.text')} <> ''""")
def features_roundtrip(spark, sf):
    """Sparse vectors written as features and read back: their terms and length."""
    terms = tfidf.row_terms(
        tfidf.prepare_text(v.docs(spark, sf), label=None), "review_id", ngram=(1, 1)
    )
    vocabulary = stages.materialize(tfidf.fit_vocabulary(terms, max_features=None), "vocabulary")
    rows = tfidf.tfidf_rows(terms, vocabulary, "review_id", words=False)
    path = _folder(spark, "features")
    stages.write_features(tfidf.tfidf_vectors(rows, vocabulary.count(), "review_id"), path)
    return _indices(stages.read_features(spark, path))


@query(f"""{v.with_views(v.URLS)}
SELECT line FROM (SELECT unnest(['=== Review ===', '', url, '', '=== Reply ===', '', upper(url), ''])
  AS line FROM urls)""")
def text_blocks(spark, sf):
    """Review and reply as blocks of text."""
    df = v.urls(spark, sf).withColumn("reply", F.upper("url"))
    path = _folder(spark, "text")
    stages.write_text(df, path, ["url", "reply"], ["Review", "Reply"])
    return spark.read.text(path).withColumnRenamed("value", "line")
