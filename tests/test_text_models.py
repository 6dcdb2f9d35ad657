import math

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import evaluate, lexicon, ratings, tfidf
from reviewlab.operators.summarize import sentences, summarize_long

DOCS = [(1, "good coat good"), (2, "good shoe"), (3, "coat shoe warm"), (4, "zzz")]


@pytest.fixture(scope="module")
def terms(spark):
    df = spark.createDataFrame(DOCS, "row_id int, text string")
    return tfidf.row_terms(tfidf.prepare_text(df, label=None))


def test_tfidf_of_three_documents(spark, terms):
    three = terms.filter("row_id < 4")
    vocabulary = tfidf.fit_vocabulary(three)
    got = [(r.term, r.term_id, r.df, r.cf, round(r.idf, 4)) for r in
           vocabulary.orderBy("term_id").collect()]
    assert got == [("coat", 0, 2, 2, 1.2877), ("good", 1, 2, 3, 1.2877), ("shoe", 2, 2, 2, 1.2877)]
    rows = tfidf.tfidf_rows(three, vocabulary)
    weights = {(r.row_id, r.term): round(r.weight, 4) for r in tfidf.tfidf_long(rows).collect()}
    assert weights == {
        (1, "coat"): 0.5085, (1, "good"): 0.8610, (2, "good"): 0.7071, (2, "shoe"): 0.7071,
        (3, "coat"): 0.7071, (3, "shoe"): 0.7071,
    }


def test_rows_without_terms_stay_and_unseen_terms_go(terms):
    vocabulary = tfidf.fit_vocabulary(terms.filter("row_id < 4"))
    rows = tfidf.tfidf_rows(terms, vocabulary)
    vectors = {r.row_id: r.features for r in tfidf.tfidf_vectors(rows, 3).collect()}
    assert len(vectors) == 4 and vectors[4].numNonzeros() == 0
    assert vectors[1].size == 3 and vectors[1].norm(2) == pytest.approx(1.0)


def test_vocabulary_cap_keeps_frequent_terms(terms):
    kept = tfidf.fit_vocabulary(terms, min_df=1, max_df=1.0, max_features=3)
    assert [r.term for r in kept.orderBy("term_id").collect()] == ["coat", "good", "shoe"]
    with pytest.raises(ValueError):
        tfidf.fit_vocabulary(terms, max_features=0)
    assert [r.feature for r in tfidf.vocabulary_table(kept).orderBy("feature").collect()][0] == "coat"


def test_prepare_drops_foreign_labels_and_empty_text(spark):
    df = spark.createDataFrame(
        [("Positive", "ok text"), ("other", "ok"), ("Neutral", "!!! http://x.y"), ("Neutral", None)],
        "sentiment string, text string",
    )
    assert [r.text_norm for r in tfidf.prepare_text(df).collect()] == ["ok text"]


def test_join_labels_checks_both_sides(spark):
    left = spark.createDataFrame([(1, 0.1), (2, 0.2)], "row_id int, f double")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "row_id int, l string")
    assert tfidf.join_labels(left, right).count() == 2
    with pytest.raises(Exception, match="no match for row 2: features only"):
        tfidf.join_labels(left, right.filter("row_id = 1")).collect()
    with pytest.raises(Exception, match="no match for row 1: label only"):
        tfidf.join_labels(left.filter("row_id = 2"), right).collect()


WORDS = [("good", 2.0), ("bad", -2.0), (":)", 1.0)]
TEXTS = [(1, "Good coat, BAD zip!"), (2, "very good!"), (3, "not a good one :)"), (4, ""), (5, None)]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(WORDS, "term string, valence double")


def test_lexicon_scores(spark, words):
    df = spark.createDataFrame(TEXTS, "row_id int, text string")
    compound = {r.row_id: r for r in lexicon.lexicon_compound(df, words).collect()}
    assert [compound[i].label for i in range(1, 6)] == [
        "Neutral", "Positive", "Positive", "Neutral", "Neutral",
    ]
    assert [compound[i].hits for i in range(1, 6)] == [2, 1, 2, 0, 0]
    assert compound[2].compound == pytest.approx(2 / math.sqrt(4 + 15))
    polarity = {r.row_id: r.polarity for r in lexicon.lexicon_polarity(df, words).collect()}
    assert polarity == {1: 0.0, 2: 2.0, 3: 1.5, 4: 0.0, 5: 0.0}


def test_neighbouring_words_change_valence(spark, words):
    df = spark.createDataFrame(TEXTS[:3], "row_id int, text string")
    modifiers = spark.createDataFrame(
        [("not", "negator", None), ("very", "booster", 1.0)],
        "term string, kind string, direction double",
    )
    s = {
        r.row_id: r.polarity * r.hits
        for r in lexicon.lexicon_polarity(df, words, modifiers=modifiers).collect()
    }
    assert s[1] == 0.0
    assert s[2] == pytest.approx(2.293)
    # "not" is two words before "good" and four before the emoticon.
    assert s[3] == pytest.approx(2.0 * -0.74 + 1.0)


def test_missing_lexicon_model_predicts_positive(spark, words):
    df = spark.createDataFrame([(1, "bad")], "row_id int, text string")
    scored = lexicon.lexicon_compound(df, words)
    got = lexicon.attach_predictions(df, {"a": scored, "b": None}).first()
    assert (got.a, got.b) == ("Negative", "Positive")


def test_adjusted_ratings(spark):
    data = [("5", "Positive", 5.0), ("4", "Positive", 4.25), ("3", "Neutral", 3.0),
            ("1", "Negative", 1.0), ("2", "Negative", 1.75), ("0", "Negative", 1.0),
            ("3", " Positive ", 3.25), ("3", "other", 3.0), ("x", "Positive", None),
            ("3", None, None)]
    df = spark.createDataFrame(
        [(i, o, s, "t") for i, (o, s, _) in enumerate(data)],
        "review_id int, overall string, sentiment string, text string",
    )
    adjusted = ratings.adjust_ratings(df)
    got = {r.review_id: r.adjusted_rating for r in adjusted.collect()}
    assert got == {i: a for i, (_, _, a) in enumerate(data) if a is not None}
    summary = ratings.rating_adjustment_summary(adjusted).first()
    assert summary.total_reviews_processed == 8
    assert summary.sentiment_counts == {"Negative": 3, "Neutral": 1, "Positive": 3, "other": 1}


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "y_true string, y_pred string")


def test_metrics_count_an_absent_class_as_zero(spark):
    p, n = "Positive", "Neutral"
    df = predictions(spark, [(p, p), (p, p), (p, n), (n, p)])
    assert tuple(evaluate.classification_metrics(df).first()) == (0.5, 0.2222, 0.2222, 0.2222)


def test_accuracy_counts_foreign_labels_but_the_matrix_does_not(spark):
    df = predictions(spark, [("Positive", "Positive"), ("odd", "odd"), ("Negative", None)])
    m = evaluate.classification_metrics(df).first()
    assert m.accuracy == 0.6667
    matrix = {r.actual: tuple(r)[1:] for r in evaluate.confusion_matrix(df).collect()}
    assert matrix == {
        "actual_Positive": (1, 0, 0), "actual_Neutral": (0, 0, 0), "actual_Negative": (0, 0, 0),
    }
    assert evaluate.confusion_long(df).agg(F.sum("n")).first()[0] == 1


def test_matrices_by_model(spark):
    df = predictions(spark, [("Positive", "Neutral")]).withColumn("model", F.lit("m"))
    rows = evaluate.confusion_matrix(df, by=["model"]).orderBy("actual").collect()
    assert [tuple(r) for r in rows] == [
        ("m", "actual_Negative", 0, 0, 0),
        ("m", "actual_Neutral", 0, 0, 0),
        ("m", "actual_Positive", 0, 1, 0),
    ]


def test_summaries(spark):
    text = "Common filler words here. Rare gem sparkles! Common filler again? " + "filler " * 100
    df = spark.createDataFrame([(1, text), (2, "short")], "review_id int, text string")
    vocabulary = spark.createDataFrame(
        [("common", 1.0), ("filler", 0.1), ("rare", 3.0), ("gem", 3.0)], "term string, idf double"
    )
    parts = df.select(sentences("text").alias("s")).first().s
    assert parts[:3] == ["Common filler words here.", "Rare gem sparkles!", "Common filler again?"]
    got = summarize_long(df, vocabulary, n=None, target_words=7).collect()
    assert [(r.review_id, r.generated_summary) for r in got] == [
        (1, "Rare gem sparkles! Common filler again?")
    ]
    with pytest.warns(UserWarning, match="only 1 long texts"):
        assert summarize_long(df, vocabulary, n=5).count() == 1
    with pytest.raises(ValueError, match="no long texts"):
        summarize_long(df, vocabulary, n=5, min_words=1000)
