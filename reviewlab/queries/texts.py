"""Text queries: n-grams, vocabulary, TF-IDF, lexicon scores, metrics of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.operators import classify, evaluate, lexicon, tfidf
from reviewlab.plans import prepare
from reviewlab.queries import views as v
from reviewlab.queries.registry import query


def _ngram_views(source: str) -> str:
    """``prep`` (rows with normalised text) and ``grams (review_id, term, tf)`` in SQL."""
    return f"""prep0 AS (SELECT *, {v.tokens_text_sql('text')} AS text_norm FROM {source}),
prep AS (SELECT * FROM prep0 WHERE length(text_norm) > 0),
tok0 AS (SELECT review_id, unnest(string_split(text_norm, ' ')) AS w,
                generate_subscripts(string_split(text_norm, ' '), 1) AS i FROM prep),
tok AS (SELECT review_id, w, lead(w) OVER (PARTITION BY review_id ORDER BY i) AS nxt
        FROM tok0 WHERE length(w) >= 2),
grams AS (SELECT review_id, term, CAST(count(*) AS INTEGER) AS tf FROM (
  SELECT review_id, w AS term FROM tok
  UNION ALL SELECT review_id, w || ' ' || nxt FROM tok WHERE nxt IS NOT NULL)
  GROUP BY review_id, term)"""


def _vocab_view(fit_on: str = "grams", rows: str = "prep", name: str = "vocab") -> str:
    return f"""{name}_n AS (SELECT count(*) AS n FROM {rows}),
{name}_c AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {fit_on}
             GROUP BY term),
{name}_k AS (SELECT term, df, cf, n FROM {name}_c, {name}_n WHERE df >= 2 AND df <= 0.95e0 * n
             ORDER BY cf DESC, term LIMIT 20000),
{name} AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, df, cf,
             ln((n + 1.0e0) / (df + 1.0e0)) + 1 AS idf FROM {name}_k)"""


_WEIGHTS_SQL = """raw AS (SELECT g.review_id, x.term_id, g.term, (1 + ln(g.tf)) * x.idf AS w
  FROM grams g JOIN vocab x USING (term)),
weights AS (SELECT review_id, term_id, term,
  round(w / sqrt(sum(w * w) OVER (PARTITION BY review_id)), 4) AS weight FROM raw)"""


def _prepared_docs(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.prepare_text(v.docs(spark, sf), label=None)


def _prepared_labeled(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.prepare_text(v.labeled_docs(spark, sf))


@query(f"""{v.with_views(v.LABELED_DOCS)}, {_ngram_views('labeled_docs')}
SELECT review_id, term, tf FROM grams""")
def ngrams(spark, sf):
    return tfidf.tokenize_ngrams(_prepared_labeled(spark, sf), "review_id")


@query(f"""{v.with_views(v.DOCS)}, {_ngram_views('docs')}, {_vocab_view()}
SELECT term, term_id, df, cf, round(idf, 6) AS idf FROM vocab""")
def vocabulary(spark, sf):
    terms = tfidf.row_terms(_prepared_docs(spark, sf), "review_id")
    return tfidf.fit_vocabulary(terms).withColumn("idf", F.round("idf", 6))


@query(f"""{v.with_views(v.DOCS)}, {_ngram_views('docs')}, {_vocab_view()}
SELECT term AS feature FROM vocab""")
def vocabulary_table(spark, sf):
    terms = tfidf.row_terms(_prepared_docs(spark, sf), "review_id")
    return tfidf.vocabulary_table(tfidf.fit_vocabulary(terms))


@query(f"""{v.with_views(v.LABELED_DOCS)}, {_ngram_views('labeled_docs')}, {_vocab_view()},
{_WEIGHTS_SQL} SELECT * FROM weights""")
def tfidf_long(spark, sf):
    terms = tfidf.row_terms(_prepared_labeled(spark, sf), "review_id")
    rows = tfidf.tfidf_rows(terms, tfidf.fit_vocabulary(terms), "review_id")
    return tfidf.tfidf_long(rows, "review_id").withColumn("weight", F.round("weight", 4))


@query(f"""{v.with_views(v.DOCS, v.LABELED_DOCS)}, {_ngram_views('docs')},
fitted AS (SELECT g.* FROM grams g WHERE review_id IN (SELECT review_id FROM labeled_docs)),
fitrows AS (SELECT * FROM prep WHERE review_id IN (SELECT review_id FROM labeled_docs)),
{_vocab_view('fitted', 'fitrows')}, {_WEIGHTS_SQL}
SELECT p.review_id, count(w.term_id) AS terms, CAST(coalesce(sum(round(w.weight * 10000)), 0) AS BIGINT) AS weight_sum
FROM prep p LEFT JOIN weights w ON w.review_id = p.review_id GROUP BY p.review_id""")
def tfidf_transform(spark, sf):
    """Vocabulary fitted on the labelled documents, applied to all of them."""
    fitted = tfidf.row_terms(_prepared_labeled(spark, sf), "review_id")
    every = tfidf.row_terms(_prepared_docs(spark, sf), "review_id")
    rows = tfidf.tfidf_rows(every, tfidf.fit_vocabulary(fitted), "review_id", words=False)
    total = F.aggregate(
        "entries",
        F.lit(0).cast("bigint"),
        lambda a, e: a + F.round(F.round(e["weight"], 4) * 10000).cast("bigint"),
    )
    return rows.select(
        "review_id",
        F.size("entries").cast("bigint").alias("terms"),
        total.alias("weight_sum"),
    )


@query(f"""{v.with_views(v.LABELED_DOCS)}, {_ngram_views('labeled_docs')}, {_vocab_view()}
SELECT (SELECT count(*) FROM labeled_docs) AS rows_input, count(*) AS rows_kept,
       count(*) FILTER (sentiment = 'Positive') AS n_positive,
       count(*) FILTER (sentiment = 'Neutral') AS n_neutral,
       count(*) FILTER (sentiment = 'Negative') AS n_negative,
       (SELECT count(*) FROM vocab) AS vocabulary_size FROM prep""")
def tfidf_summary(spark, sf):
    prepared = _prepared_labeled(spark, sf)
    vocab = tfidf.fit_vocabulary(tfidf.row_terms(prepared, "review_id"))
    report = tfidf.tfidf_summary(v.labeled_docs(spark, sf), prepared, vocab)
    return report.drop("tfidf_config")


# --- lexicon scores ------------------------------------------------------------------------

_EDGE = r"!-/:-@\[-`{-~"
_BARE = f"regexp_replace(w, '^[{_EDGE}]+|[{_EDGE}]+$', '', 'g')"


def _words_views(source: str) -> str:
    words = v.split_words_sql("lower(text)")
    return f"""lw0 AS (SELECT review_id, unnest({words}) AS w,
                generate_subscripts({words}, 1) AS i FROM {source}),
lw AS (SELECT review_id, i, CASE WHEN length({_BARE}) <= 2 THEN w ELSE {_BARE} END AS token
       FROM lw0),
sc AS (SELECT review_id, count(valence) AS hits, coalesce(sum(valence), 0) AS s,
              coalesce(avg(valence), 0) AS m
       FROM {source} LEFT JOIN lw USING (review_id) LEFT JOIN lexicon ON term = token
       GROUP BY review_id),
fin AS (SELECT review_id, hits, s / sqrt(s * s + 15) AS compound, m AS polarity FROM sc)"""


_COMPOUND_LABEL = (
    "CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative' "
    "ELSE 'Neutral' END"
)
_POLARITY_LABEL = (
    "CASE WHEN polarity > 0 THEN 'Positive' WHEN polarity < 0 THEN 'Negative' ELSE 'Neutral' END"
)


@query(f"""{v.with_views(v.DOCS, v.LEXICON_SQL)}, {_words_views('docs')}
SELECT review_id, hits, round(compound, 6) AS compound, {_COMPOUND_LABEL} AS label FROM fin""")
def lexicon_compound(spark, sf):
    df = lexicon.lexicon_compound(v.docs(spark, sf), v.lexicon(spark), "review_id")
    return df.withColumn("compound", F.round("compound", 6))


@query(f"""{v.with_views(v.DOCS, v.LEXICON_SQL)}, {_words_views('docs')}
SELECT review_id, hits, round(polarity, 6) AS polarity, {_POLARITY_LABEL} AS label FROM fin""")
def lexicon_polarity(spark, sf):
    df = lexicon.lexicon_polarity(v.docs(spark, sf), v.lexicon(spark), "review_id")
    return df.withColumn("polarity", F.round("polarity", 6))


@query(f"""{v.with_views(v.DOCS, v.LEXICON_SQL)},
mods(term, kind, direction) AS (VALUES ('the', 'booster', CAST(1 AS DOUBLE)),
  ('of', 'booster', CAST(-1 AS DOUBLE)), ('and', 'negator', CAST(NULL AS DOUBLE)),
  ('en', 'negator', CAST(NULL AS DOUBLE))),
{_words_views('docs')},
ctx AS (SELECT review_id, token, lag(token, 1) OVER o AS p1, lag(token, 2) OVER o AS p2,
               lag(token, 3) OVER o AS p3 FROM lw WINDOW o AS (PARTITION BY review_id ORDER BY i)),
val AS (SELECT review_id, (valence
    + CASE WHEN m1.kind = 'booster' THEN m1.direction * 0.293e0 * 1.0e0 * sign(valence) ELSE 0 END
    + CASE WHEN m2.kind = 'booster' THEN m2.direction * 0.293e0 * 0.95e0 * sign(valence) ELSE 0 END
    + CASE WHEN m3.kind = 'booster' THEN m3.direction * 0.293e0 * 0.9e0 * sign(valence) ELSE 0 END)
    * CASE WHEN m1.kind = 'negator' THEN -0.74e0 ELSE 1 END
    * CASE WHEN m2.kind = 'negator' THEN -0.74e0 ELSE 1 END
    * CASE WHEN m3.kind = 'negator' THEN -0.74e0 ELSE 1 END AS x
  FROM ctx JOIN lexicon l ON l.term = token LEFT JOIN mods m1 ON m1.term = p1
  LEFT JOIN mods m2 ON m2.term = p2 LEFT JOIN mods m3 ON m3.term = p3),
tot AS (SELECT d.review_id, count(x) AS hits, coalesce(sum(x), 0) AS s
        FROM docs d LEFT JOIN val USING (review_id) GROUP BY d.review_id)
SELECT review_id, hits, round(s / sqrt(s * s + 15), 6) AS compound FROM tot""")
def lexicon_modified(spark, sf):
    """Compound score with negators and boosters among the three words before."""
    modifiers = spark.createDataFrame(
        [("the", "booster", 1.0), ("of", "booster", -1.0), ("and", "negator", None),
         ("en", "negator", None)],
        "term string, kind string, direction double",
    )
    df = lexicon.lexicon_compound(
        v.docs(spark, sf), v.lexicon(spark), "review_id", modifiers=modifiers
    )
    return df.select("review_id", "hits", F.round("compound", 6).alias("compound"))


# --- metrics -----------------------------------------------------------------------------------

_PREDICTED_SQL = f"""{v.with_views(v.LABELED_DOCS, v.LEXICON_SQL, v.DOMAIN)},
{_words_views('labeled_docs')},
both_models AS (SELECT review_id, {_COMPOUND_LABEL} AS compound_pred,
                {_POLARITY_LABEL} AS polarity_pred FROM fin),
pred AS (SELECT l.review_id, l.sentiment AS y, b.compound_pred, b.polarity_pred
         FROM labeled_docs l JOIN both_models b ON b.review_id = l.review_id)"""


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    df = v.labeled_docs(spark, sf)
    words = v.lexicon(spark)
    return lexicon.attach_predictions(
        df.select("review_id", "sentiment"),
        {
            "compound_pred": lexicon.lexicon_compound(df, words, "review_id"),
            "polarity_pred": lexicon.lexicon_polarity(df, words, "review_id"),
        },
        "review_id",
    )


@query(f"""{_PREDICTED_SQL}
SELECT 'actual_' || label AS actual, count(*) FILTER (compound_pred = 'Positive') AS "pred_Positive",
       count(*) FILTER (compound_pred = 'Neutral') AS "pred_Neutral",
       count(*) FILTER (compound_pred = 'Negative') AS "pred_Negative"
FROM domain LEFT JOIN pred ON y = label GROUP BY label""")
def confusion(spark, sf):
    return evaluate.confusion_matrix(_predicted(spark, sf), "sentiment", "compound_pred")


@query(f"""{_PREDICTED_SQL}
SELECT a.label AS actual, b.label AS predicted, count(review_id) AS n
FROM domain a CROSS JOIN domain b
LEFT JOIN pred ON y = a.label AND polarity_pred = b.label GROUP BY a.label, b.label""")
def confusion_cells(spark, sf):
    return evaluate.confusion_long(_predicted(spark, sf), "sentiment", "polarity_pred")


def _metrics_sql(model: str, col: str) -> str:
    return f"""SELECT '{model}' AS model,
  round((SELECT count(*) FILTER (y = {col}) * 1.0e0 / count(*) FROM pred), 4) AS accuracy,
  round(avg(CASE WHEN g > 0 THEN tp * 1.0e0 / g ELSE 0 END), 4) AS macro_precision,
  round(avg(CASE WHEN t > 0 THEN tp * 1.0e0 / t ELSE 0 END), 4) AS macro_recall,
  round(avg(CASE WHEN t + g > 0 THEN 2.0e0 * tp / (t + g) ELSE 0 END), 4) AS macro_f1
FROM (SELECT label, count(*) FILTER (y = label AND {col} = label) AS tp,
             count(*) FILTER (y = label) AS t, count(*) FILTER ({col} = label) AS g
      FROM domain, pred GROUP BY label)"""


@query(
    f"{_PREDICTED_SQL} SELECT * EXCLUDE (model) FROM ({_metrics_sql('m', 'compound_pred')})"
)
def metrics(spark, sf):
    return evaluate.classification_metrics(_predicted(spark, sf), "sentiment", "compound_pred")


@query(
    f"{_PREDICTED_SQL} {_metrics_sql('compound_pred', 'compound_pred')} "
    f"UNION ALL {_metrics_sql('polarity_pred', 'polarity_pred')}"
)
def compare_models(spark, sf):
    return evaluate.compare_models(
        _predicted(spark, sf), ["compound_pred", "polarity_pred"], "review_id", "sentiment"
    )


@query(f"""{v.with_views(v.LABELED_DOCS)}, {_ngram_views('labeled_docs')}
SELECT p.review_id, p.sentiment, count(g.term) AS terms
FROM prep p LEFT JOIN grams g ON g.review_id = p.review_id GROUP BY p.review_id, p.sentiment""")
def join_labels(spark, sf):
    """Term counts matched to labels by key, with both sides checked for gaps."""
    prepared = _prepared_labeled(spark, sf)
    counted = tfidf.row_terms(prepared, "review_id").select(
        "review_id", F.size("terms").cast("bigint").alias("terms")
    )
    return tfidf.join_labels(counted, prepared.select("review_id", "sentiment"), "review_id")


@query(f"""{v.with_views(v.REVIEWS)},
s AS (SELECT CAST(asin AS INTEGER) AS candidate, round(avg(overall), 2) AS mean_test_score
      FROM reviews GROUP BY asin),
r AS (SELECT *, CAST(rank() OVER (ORDER BY mean_test_score DESC) AS INTEGER) AS rank_test_score
      FROM s)
SELECT * FROM r ORDER BY rank_test_score, candidate LIMIT 10""")
def rank_candidates(spark, sf):
    """The ten best by mean score, equal scores sharing a rank."""
    scores = v.reviews(spark, sf).groupBy(F.col("asin").cast("int").alias("candidate")).agg(
        F.round(F.avg("overall"), 2).alias("mean_test_score")
    )
    return classify.rank_candidates(scores)


@query(f"""{v.with_views(v.LABELED_DOCS)}
SELECT sentiment, count(*) AS n, round((sum(count(*)) OVER ()) * 1.0e0
  / ((count(*) OVER ()) * count(*)), 6) AS weight
FROM labeled_docs GROUP BY sentiment""")
def class_weights(spark, sf):
    df = classify.class_weights(v.labeled_docs(spark, sf))
    return df.withColumn("weight", F.round("weight", 6))


RAW_SQL = """raw AS (
  SELECT review_id, CAST(overall AS VARCHAR) AS overall, asin AS summary, text AS body, asin
  FROM labeled_docs
  UNION ALL SELECT -review_id - 1, 'none', asin, text, asin FROM labeled_docs WHERE review_id % 5 = 0
  UNION ALL SELECT -review_id - 100000001, ' 4.5 ', NULL, NULL, asin FROM labeled_docs
    WHERE review_id % 7 = 0
  UNION ALL SELECT -review_id - 200000001, '2', '', ' ' || text, NULL FROM labeled_docs
    WHERE review_id % 3 = 0)"""


PREPARED_SQL = f"""parsed AS (SELECT *, TRY_CAST(trim(overall) AS DOUBLE) AS stars,
  {v.strip_sql("coalesce(summary, '') || ' ' || coalesce(body, '')")} AS text_raw FROM raw),
cleaned AS (SELECT *, {v.clean_sql('text_raw')} AS text FROM parsed WHERE stars IS NOT NULL),
prepared AS (SELECT review_id, stars AS overall, {v.label_sql('stars')} AS sentiment, text, text_raw,
  CAST(len({v.split_words_sql('text')}) AS INTEGER) AS word_len,
  CAST(length(text) AS INTEGER) AS char_len, asin
FROM cleaned WHERE text <> '' AND {v.label_sql('stars')} IS NOT NULL)"""


def raw_reviews(spark, sf):
    """The documents as raw reviews, with rows added that lack a rating or text."""
    docs = v.labeled_docs(spark, sf).select(
        "review_id", F.col("overall").cast("string").alias("overall"),
        F.col("asin").alias("summary"), F.col("text").alias("reviewText"), "asin",
    )
    none = F.lit(None).cast("string")
    unrated = docs.filter("review_id % 5 = 0").withColumns(
        {"review_id": -F.col("review_id") - 1, "overall": F.lit("none")}
    )
    empty = docs.filter("review_id % 7 = 0").withColumns(
        {"review_id": -F.col("review_id") - 100_000_001, "overall": F.lit(" 4.5 "),
         "summary": none, "reviewText": none}
    )
    bare = docs.filter("review_id % 3 = 0").withColumns(
        {"review_id": -F.col("review_id") - 200_000_001, "overall": F.lit("2"),
         "summary": F.lit(""), "reviewText": F.concat(F.lit(" "), "reviewText"), "asin": none}
    )
    return docs.unionByName(unrated).unionByName(empty).unionByName(bare)


@query(f"""{v.with_views(v.LABELED_DOCS, RAW_SQL)},
{PREPARED_SQL} SELECT * FROM prepared""")
def prepare_reviews(spark, sf):
    """Labelled and cleaned rows of the documents, with rows added that lack a rating or text."""
    return prepare.prepare_reviews(raw_reviews(spark, sf))


@query(f"""{v.with_views(v.LABELED_DOCS)}
SELECT sentiment AS label, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labeled_docs GROUP BY sentiment""")
def set_sizes(spark, sf):
    return evaluate.set_sizes(v.labeled_docs(spark, sf))
