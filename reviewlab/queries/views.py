"""Review-shaped views over the given tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.functions.labels import label_sentiment
from reviewlab.functions.text import text_lengths
from reviewlab.sources.stages import spread

# Whitespace as the SQL engine's regular expressions spell it.
WS_SQL = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# A small lexicon over words the documents contain.
LEXICON = [
    ("worthless", -2.5), ("that", 0.5), ("with", 1.25), ("was", -0.5), ("for", 0.75),
    ("this", 0.25), ("are", -0.25), ("la", 1.0), ("de", -0.75), ("que", -1.25), ("le", 0.5),
    ("der", -0.5), ("und", 1.25), ("die", -2.0), ("von", 0.75), ("les", -0.25), ("est", 1.5),
    ("pour", 2.0), ("mit", 0.5), ("ist", -1.0), ("from", 1.0), ("it", -0.25), ("by", 0.25),
    ("los", -1.5), ("del", 0.5), ("qui", -0.75), ("sur", 1.25), ("then", -1.0), ("than", 0.75),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reviews: unique key, stars from the priority digit, user = customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").cast("string").alias("reviewerID"),
        (F.col("o_orderkey") % 701).cast("string").alias("asin"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("overall"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("unixReviewTime"),
        F.when(F.col("o_orderstatus") == "F", True)
        .when(F.col("o_orderstatus") == "O", False)
        .alias("verified"),
        F.format_number(F.floor("o_totalprice"), 0).alias("vote"),
    )


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).withColumn("sentiment", label_sentiment("overall"))


def product_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reviews of parts. No unique key."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("asin"),
        F.when(F.col("l_linenumber") <= 5, F.col("l_linenumber").cast("double")).alias("overall"),
        F.when(F.col("l_returnflag") == "A", True)
        .when(F.col("l_returnflag") == "N", False)
        .alias("verified"),
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"), "text", F.col("source").alias("asin"), "lang"
    )
    return spread(rows, "review_id")


def measured_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lengths(docs(spark, sf_dir))


def labeled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stars = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("toxic") == 1, 1.0)
        .when(F.col("quality") == 1, 5.0)
        .otherwise(3.0)
        .alias("overall"),
    )
    return (
        docs(spark, sf_dir)
        .join(stars, "review_id")
        .withColumn("sentiment", label_sentiment("overall"))
    )


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("review_id"), "url")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, valence double")


# --- the same views in SQL -------------------------------------------------------------

_LABEL = (
    "CASE WHEN {x} >= 4 THEN 'Positive' WHEN {x} = 3 THEN 'Neutral' "
    "WHEN {x} <= 2 THEN 'Negative' END"
)


def label_sql(x: str) -> str:
    return _LABEL.format(x=x)


REVIEWS = f"""reviews AS (
  SELECT r.*, {label_sql('overall')} AS sentiment FROM (
    SELECT o_orderkey AS review_id, CAST(o_custkey AS VARCHAR) AS "reviewerID",
           CAST(o_orderkey % 701 AS VARCHAR) AS asin,
           CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS overall,
           CAST(epoch(o_orderdate) AS BIGINT) AS "unixReviewTime",
           CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS verified,
           format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) AS vote
    FROM orders) r)"""

PRODUCT_REVIEWS = """product_reviews AS (
  SELECT CAST(l_partkey AS VARCHAR) AS asin,
         CASE WHEN l_linenumber <= 5 THEN CAST(l_linenumber AS DOUBLE) END AS overall,
         CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'N' THEN FALSE END AS verified
  FROM lineitem)"""


def split_words_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS_SQL}]+'), lambda w: w <> '')"


DOCS = f"""docs AS (
  SELECT doc_id AS review_id, text, source AS asin, lang,
         CAST(len({split_words_sql('text')}) AS INTEGER) AS word_len,
         CAST(length(text) AS INTEGER) AS char_len
  FROM documents)"""

LABELED_DOCS = f"""labeled_docs AS (
  SELECT x.*, {label_sql('overall')} AS sentiment FROM (
    SELECT d.doc_id AS review_id, d.text, d.source AS asin, d.lang,
           CASE WHEN l.toxic = 1 THEN CAST(1 AS DOUBLE) WHEN l.quality = 1 THEN CAST(5 AS DOUBLE)
                ELSE CAST(3 AS DOUBLE) END AS overall
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id) x)"""

URLS = "urls AS (SELECT page_id AS review_id, url FROM pages)"

LEXICON_SQL = "lexicon(term, valence) AS (VALUES {})".format(
    ", ".join(f"('{t}', CAST({v} AS DOUBLE))" for t, v in LEXICON)
)

DOMAIN = "domain(label) AS (VALUES ('Positive'), ('Neutral'), ('Negative'))"


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS_SQL}]+', ' ', 'g'))"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_SQL}]+|[{WS_SQL}]+$', '', 'g')"


def clean_sql(x: str) -> str:
    invisible = "chr(8203) || chr(8204) || chr(8205) || chr(65279)"
    visible = f"replace(translate({x}, {invisible}, '    '), chr(173), '')"
    no_url = f"regexp_replace({visible}, 'https?://[^{WS_SQL}]+|www\\.[^{WS_SQL}]+', '', 'g')"
    return squeeze_sql(f"lower({no_url})")


def tokens_text_sql(x: str) -> str:
    return f"trim(regexp_replace({clean_sql(x)}, '[^a-z0-9]+', ' ', 'g'))"


def hash_sql(key: str, seed: int | str = 42) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def with_views(*views: str) -> str:
    return "WITH " + ", ".join(views)
