"""Row-local queries: labels, text, numbers, dates, ratings, prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.functions.labels import (
    label_sentiment as label_of,
    parse_votes as votes_of,
    review_calendar as calendar_of,
    threshold_label,
    to_number as number_of,
)
from reviewlab.functions.prompts import (
    ECHO_MARKERS,
    REPLY_PROMPT,
    SUMMARY_PROMPT,
    build_prompt,
    clean_generated as cleaned_output,
    strip_echo,
)
from reviewlab.functions.text import (
    build_text as joined_text,
    clean_text as cleaned,
    normalize_tokens as token_text,
    normalize_ws,
    preview as cut,
)
from reviewlab.operators import ratings
from reviewlab.operators.generate import detect_questions as question_texts
from reviewlab.operators.generate import long_texts as texts_over
from reviewlab.operators.tfidf import filter_domain as in_domain
from reviewlab.plans.prepare import drop_invalid
from reviewlab.queries import views as v
from reviewlab.queries.registry import query
from reviewlab.schema import select_existing as existing

# Every 40th rating is replaced by something a rating file may hold.
_ODD = {
    0: "3.5", 1: "abc", 2: "NaN", 3: " 4 ", 4: "inf", 5: "1d", 6: "-1", 7: "1e1",
    8: "1_000", 9: "1,234", 10: "", 11: "0x1p3", 12: "+2.", 13: ".5",
}
_ODD_SQL = "CASE review_id % 40 {} ELSE CAST(overall AS VARCHAR) END".format(
    " ".join(f"WHEN {k} THEN '{s}'" for k, s in _ODD.items())
)
_NUMBER_SQL = (
    "CASE WHEN regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') "
    "OR regexp_matches({x}, '^\\s*[+-]?(?i:inf|infinity)\\s*$') "
    "THEN TRY_CAST(trim({x}) AS DOUBLE) END"
)


def _odd_ratings(spark: SparkSession, sf: str) -> DataFrame:
    df = v.reviews(spark, sf)
    text = F.col("overall").cast("string")
    for k, s in _ODD.items():
        text = F.when(F.col("review_id") % 40 == k, F.lit(s)).otherwise(text)
    return df.select("review_id", text.alias("rating_text"))


_ODD_VIEW = f"odd AS (SELECT review_id, {_ODD_SQL} AS rating_text FROM reviews)"
_NUM_VIEW = f"num AS (SELECT *, {_NUMBER_SQL.format(x='rating_text')} AS number FROM odd)"


@query(f"""{v.with_views(v.REVIEWS, _ODD_VIEW, _NUM_VIEW)}
SELECT * FROM (SELECT review_id, rating_text, {v.label_sql('number')} AS sentiment FROM num)
WHERE sentiment IS NOT NULL""")
def label_sentiment(spark, sf):
    labelled = _odd_ratings(spark, sf).withColumn("sentiment", label_of("rating_text"))
    return drop_invalid(labelled, ["sentiment"])


@query(f"""{v.with_views(v.REVIEWS, _ODD_VIEW, _NUM_VIEW)}
SELECT review_id, least(number, 1e9) AS number FROM num WHERE number IS NOT NULL""")
def to_number(spark, sf):
    numbers = _odd_ratings(spark, sf).select("review_id", number_of("rating_text").alias("number"))
    return drop_invalid(numbers, ["number"]).withColumn("number", F.least("number", F.lit(1e9)))


# Every whole text, and rows of missing, empty and padded texts beside them.
_PARTS_SQL = """parts AS (
  SELECT review_id, CASE WHEN review_id % 3 <> 0 THEN asin END AS summary, text AS body
  FROM labeled_docs
  UNION ALL
  SELECT -review_id - 1, CASE WHEN review_id % 2 = 0 THEN asin END,
    CASE review_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '  ' || text || ' ' || chr(9) END
  FROM labeled_docs)"""


@query(f"""{v.with_views(v.LABELED_DOCS, _PARTS_SQL)}
SELECT review_id, {v.strip_sql("coalesce(summary, '') || ' ' || coalesce(body, '')")} AS text_raw
FROM parts""")
def build_text(spark, sf):
    i = F.col("review_id")
    docs = v.labeled_docs(spark, sf)
    whole = docs.select(
        i, F.when(i % 3 != 0, F.col("asin")).alias("summary"), F.col("text").alias("reviewText")
    )
    edges = docs.select(
        (-i - 1).alias("review_id"),
        F.when(i % 2 == 0, F.col("asin")).alias("summary"),
        F.when(i % 3 == 0, None)
        .when(i % 3 == 1, "")
        .otherwise(F.concat(F.lit("  "), F.col("text"), F.lit(" \t")))
        .alias("reviewText"),
    )
    parts = whole.union(edges)
    return parts.select("review_id", joined_text(parts).alias("text_raw"))


# Documents and pages as one text column, with URLs and invisible characters put in.
_MESSY_SQL = """messy AS (
  SELECT 'd' || CAST(review_id AS VARCHAR) AS review_id,
         text || chr(8203) || 'En' || chr(173) || 'd' || chr(160) || 'HTTP://X.com (https://a.b/'
         || CAST(review_id AS VARCHAR) || ') www.x.org' || chr(8195) || 'don''t_stop' AS text
  FROM docs
  UNION ALL
  SELECT 'p' || CAST(review_id AS VARCHAR), 'See ' || url || ' NOW' || chr(9) || chr(65279) || 'ok'
  FROM urls)"""


def _messy(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("review_id").cast("string")
    documents = v.docs(spark, sf).select(
        F.concat(F.lit("d"), i).alias("review_id"),
        F.concat(
            F.col("text"),
            F.lit("\u200bEn\u00add\u00a0HTTP://X.com (https://a.b/"),
            i,
            F.lit(") www.x.org\u2003don't_stop"),
        ).alias("text"),
    )
    pages = v.urls(spark, sf).select(
        F.concat(F.lit("p"), i).alias("review_id"),
        F.concat(F.lit("See "), F.col("url"), F.lit(" NOW\t\ufeffok")).alias("text"),
    )
    return documents.unionByName(pages)


@query(f"""{v.with_views(v.DOCS, v.URLS, _MESSY_SQL)}
SELECT review_id, {v.clean_sql('text')} AS text FROM messy""")
def clean_text(spark, sf):
    return _messy(spark, sf).select("review_id", cleaned("text").alias("text"))


@query(f"""{v.with_views(v.DOCS, v.URLS, _MESSY_SQL)}
SELECT review_id, {v.squeeze_sql('lower(text)')} AS text_norm FROM messy""")
def normalize_text(spark, sf):
    return _messy(spark, sf).select("review_id", normalize_ws("text").alias("text_norm"))


@query(f"""{v.with_views(v.DOCS, v.URLS, _MESSY_SQL)}
SELECT review_id, {v.tokens_text_sql('text')} AS text_norm FROM messy""")
def normalize_tokens(spark, sf):
    return _messy(spark, sf).select("review_id", token_text("text").alias("text_norm"))


@query(f"""{v.with_views(v.REVIEWS)}
SELECT review_id, TRY_CAST(replace(vote, ',', '') AS DOUBLE) AS votes FROM reviews""")
def parse_votes(spark, sf):
    return v.reviews(spark, sf).select("review_id", votes_of("vote").alias("votes"))


@query(f"""{v.with_views(v.REVIEWS)}
SELECT review_id, strftime(make_timestamp("unixReviewTime" * 1000000), '%Y-%m-%d %H:%M:%S') AS at,
       strftime(date_trunc('month', make_timestamp("unixReviewTime" * 1000000)), '%Y-%m-%d')
         AS month,
       CAST(month(make_timestamp("unixReviewTime" * 1000000)) AS INTEGER) AS month_of_year
FROM reviews""")
def review_calendar(spark, sf):
    return calendar_of(v.reviews(spark, sf)).select(
        "review_id",
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.date_format("month", "yyyy-MM-dd").alias("month"),
        "month_of_year",
    )


@query(f"{v.with_views(v.DOCS)} SELECT review_id, word_len, char_len FROM docs")
def text_lengths(spark, sf):
    return v.measured_docs(spark, sf).select("review_id", "word_len", "char_len")


@query(f"{v.with_views(v.REVIEWS)} SELECT overall, asin, review_id FROM reviews")
def select_existing(spark, sf):
    return existing(v.reviews(spark, sf), ["overall", "text", "asin", "word_len", "review_id"])


@query(f"""{v.with_views(v.LABELED_DOCS)}
SELECT review_id, label FROM (
  SELECT review_id, CASE WHEN review_id % 4 = 0 THEN lang ELSE sentiment END AS label
  FROM labeled_docs)
WHERE label IN ('Positive', 'Neutral', 'Negative')""")
def filter_domain(spark, sf):
    mixed = v.labeled_docs(spark, sf).select(
        "review_id",
        F.when(F.col("review_id") % 4 == 0, F.col("lang"))
        .otherwise(F.col("sentiment"))
        .alias("label"),
    )
    return in_domain(mixed, "label")


_ADJUSTED_SQL = """adjusted AS (
  SELECT review_id, vote AS review_text, overall AS original_rating, sentiment AS sentiment_label,
         CASE sentiment WHEN 'Positive' THEN 0.25e0 WHEN 'Negative' THEN -0.25e0 ELSE 0e0 END
           AS adjustment,
         least(greatest(overall + CASE sentiment WHEN 'Positive' THEN 0.25e0
           WHEN 'Negative' THEN -0.25e0 ELSE 0e0 END, 1e0), 5e0) AS adjusted_rating
  FROM reviews WHERE overall IS NOT NULL AND sentiment IS NOT NULL)"""


def _adjusted(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.adjust_ratings(v.labelled_reviews(spark, sf).withColumn("text", F.col("vote")))


@query(f"{v.with_views(v.REVIEWS, _ADJUSTED_SQL)} SELECT * FROM adjusted")
def adjust_ratings(spark, sf):
    return _adjusted(spark, sf)


@query(f"""{v.with_views(v.REVIEWS, _ADJUSTED_SQL)}
SELECT count(*) AS total_reviews_processed,
       round(avg(original_rating), 4) AS mean_original_rating,
       round(avg(adjusted_rating), 4) AS mean_adjusted_rating,
       round(min(adjusted_rating), 4) AS min_adjusted_rating,
       round(max(adjusted_rating), 4) AS max_adjusted_rating,
       count(*) FILTER (sentiment_label = 'Positive') AS n_positive,
       count(*) FILTER (sentiment_label = 'Neutral') AS n_neutral,
       count(*) FILTER (sentiment_label = 'Negative') AS n_negative
FROM adjusted""")
def adjustment_summary(spark, sf):
    report = ratings.rating_adjustment_summary(_adjusted(spark, sf))
    per_label = F.col("sentiment_counts")
    return report.select(
        "*", *[F.try_element_at(per_label, F.lit(x)).alias(f"n_{x.lower()}")
               for x in ("Positive", "Neutral", "Negative")]
    ).drop("sentiment_counts")


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, text AS original_text, word_len AS word_count FROM docs WHERE word_len > 100""")
def long_texts(spark, sf):
    return texts_over(v.docs(spark, sf), 100)


# Questions: documents hold some phrases; page addresses hold question marks.
_ASKING_SQL = """asking AS (
  SELECT 'd' || CAST(review_id AS VARCHAR) AS review_id, text FROM docs
  UNION ALL
  SELECT 'p' || CAST(review_id AS VARCHAR) || '-' || CAST(k AS VARCHAR),
         CASE k WHEN 0 THEN url WHEN 1 THEN 'Well, CAN I ' || url
              WHEN 2 THEN 'cani ' || replace(url, '?', ' ') WHEN 3 THEN ' ok? '
              ELSE 'thi' || chr(233) || 's is this' || chr(233) END
  FROM urls, (SELECT unnest(range(5)) AS k))"""


@query(f"""{v.with_views(v.DOCS, v.URLS, _ASKING_SQL)}
SELECT review_id, text AS original_text,
       CAST(len({v.split_words_sql('text')}) AS INTEGER) AS word_count
FROM asking
WHERE regexp_matches(lower(text), '\\?|(^|[^\\p{{L}}\\p{{N}}_])(does this|is this|can i|will it|how do i|do these|would this)($|[^\\p{{L}}\\p{{N}}_])')
  AND length({v.strip_sql('text')}) > 5""")
def detect_questions(spark, sf):
    i = F.col("review_id").cast("string")
    documents = v.docs(spark, sf).select(F.concat(F.lit("d"), i).alias("review_id"), "text")
    # Every address as it is, and the edge rows made from it.
    asked = F.array(
        F.col("url"),
        F.concat(F.lit("Well, CAN I "), F.col("url")),
        F.concat(F.lit("cani "), F.replace("url", F.lit("?"), F.lit(" "))),
        F.lit(" ok? "),
        F.lit("thi\u00e9s is this\u00e9"),
    )
    pages = v.urls(spark, sf).select("review_id", F.posexplode(asked).alias("k", "text"))
    pages = pages.select(F.concat(F.lit("p"), i, F.lit("-"), F.col("k")).alias("review_id"), "text")
    return question_texts(documents.unionByName(pages))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _prompt_sql(template: str, x: str) -> str:
    before, after = template.split("{text}")
    return f"{_quoted(before)} || {x} || {_quoted(after)}"


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, {_prompt_sql(SUMMARY_PROMPT, 'text')} AS summary_prompt,
       {_prompt_sql(REPLY_PROMPT, 'text')} AS reply_prompt FROM docs""")
def build_prompts(spark, sf):
    return v.docs(spark, sf).select(
        "review_id",
        build_prompt("text", SUMMARY_PROMPT).alias("summary_prompt"),
        build_prompt("text", REPLY_PROMPT).alias("reply_prompt"),
    )


# Generator-like output made from each document: markers in front, repeated or absent; and,
# numbered below 0, an output that is too short without its marker.
_OUTPUT_SQL = """outputs AS (SELECT review_id, text, CASE review_id % 6
    WHEN 0 THEN 'Summary: ' || text WHEN 1 THEN 'Review: r1 Review: Summary: ' || text
    WHEN 3 THEN 'Soft. Summary: ' || text
    WHEN 4 THEN 'Review: ' || text || ' Summary: ' || text ELSE ' ' || text END AS raw FROM docs
    UNION ALL SELECT -1 - review_id, text, 'Summary: ok' FROM docs)"""


def _tail_sql(x: str, marker: str) -> str:
    m = _quoted(marker)
    return (
        f"CASE WHEN starts_with({x}, {m}) THEN "
        f"{v.strip_sql(f'list_extract(string_split({x}, {m}), -1)')} ELSE {x} END"
    )


def _marker_views() -> list[str]:
    out, source = [], "outputs"
    for i, marker in enumerate(ECHO_MARKERS):
        x = v.strip_sql("raw") if i == 0 else "t"
        if i == 0:
            out.append(f"m AS (SELECT *, {x} AS t FROM outputs)")
            source = "m"
        out.append(
            f"m{i} AS (SELECT * EXCLUDE (t), {_tail_sql('t', marker)} AS t FROM {source})"
        )
        source = f"m{i}"
    return out


@query(f"""{v.with_views(v.DOCS, _OUTPUT_SQL, *_marker_views())}
SELECT review_id, CASE WHEN length(t) < 8 THEN {v.strip_sql('raw')} ELSE t END AS cleaned,
       {v.strip_sql('text')} AS completion
FROM m{len(ECHO_MARKERS) - 1}""")
def clean_generated(spark, sf):
    kind = F.col("review_id") % 6
    text = F.col("text")
    raw = (
        F.when(kind == 0, F.concat(F.lit("Summary: "), text))
        .when(kind == 1, F.concat(F.lit("Review: r1 Review: Summary: "), text))
        .when(kind == 3, F.concat(F.lit("Soft. Summary: "), text))
        .when(kind == 4, F.concat(F.lit("Review: "), text, F.lit(" Summary: "), text))
        .otherwise(F.concat(F.lit(" "), text))
    )
    prompt = build_prompt("text", SUMMARY_PROMPT)
    echoed = F.concat(prompt, F.lit("\n"), text)
    docs = v.docs(spark, sf).select("review_id", "text")
    short = docs.select(-1 - F.col("review_id"), "text", F.lit("Summary: ok"))
    outputs = docs.withColumn("raw", raw).union(short)
    return outputs.select(
        "review_id",
        cleaned_output(F.col("raw")).alias("cleaned"),
        strip_echo(echoed, prompt).alias("completion"),
    )


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END
  AS preview FROM docs""")
def preview(spark, sf):
    return v.docs(spark, sf).select("review_id", cut("text").alias("preview"))


@query("""WITH s AS (SELECT event_id, (value - 245.0) / 245.0 AS score FROM events)
SELECT event_id,
       CASE WHEN score >= 0.05 THEN 'Positive' WHEN score <= -0.05 THEN 'Negative'
            ELSE 'Neutral' END AS inclusive,
       CASE WHEN score > 0 THEN 'Positive' WHEN score < 0 THEN 'Negative' ELSE 'Neutral' END
         AS by_sign
FROM s""")
def threshold_labels(spark, sf):
    scored = v.table(spark, sf, "events").select(
        "event_id", ((F.col("value") - 245.0) / 245.0).alias("score")
    )
    return scored.select(
        "event_id",
        threshold_label("score").alias("inclusive"),
        threshold_label("score", 0.0, 0.0, strict=True).alias("by_sign"),
    )
