import pytest
from pyspark.sql import functions as F

from reviewlab.functions import labels, text
from reviewlab.functions.prompts import (
    ECHO_MARKERS,
    SUMMARY_PROMPT,
    build_prompt,
    clean_generated,
    strip_echo,
)
from reviewlab.functions.terms import count_terms, ngrams, tokens
from reviewlab.schema import require_columns, select_existing

MESSY = [
    "  Great​Fit­!!  ",
    "See HTTP://X.com and http://a.b/c?d now",
    "WWW.x.com www.x.com.",
    "Café \U0001f60d don't_stop 2X",
    "(https://a.b) ok",
    "​",
    "http://only.url",
    "ww­w.hidden.com stays",
]


def test_clean_text(one):
    assert one(MESSY, text.clean_text) == [
        "great fit!!",
        "see http://x.com and now",
        "www.x.com",
        "café \U0001f60d don't_stop 2x",
        "( ok",
        "",
        "",
        "stays",
    ]


def test_normalize_tokens(one):
    expected = [
        "great fit",
        "see http x com and now",
        "www x com",
        "caf don t stop 2x",
        "ok",
        "",
        "",
        "stays",
    ]
    assert one(MESSY, text.normalize_tokens) == expected
    assert one(MESSY, text.has_tokens) == [t != "" for t in expected]


def test_whitespace_is_pythons():
    assert all(c.isspace() for c in text.WHITESPACE)
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x3001) if chr(i).isspace()}


def test_words_and_characters(one):
    values = ["a b\tc ", "", None, " 　 ", "\U0001f60d x"]
    assert one(values, text.word_count) == [3, 0, 0, 0, 2]
    assert one(values, text.char_count) == [6, 0, 0, 3, 3]
    assert one(values, text.normalize_ws) == ["a b c", "", "", "", "\U0001f60d x"]


def test_build_text(spark):
    df = spark.createDataFrame(
        [("a", "b"), (None, "b"), ("a", None), ("", " b "), (None, None)],
        "summary string, reviewText string",
    )
    assert [r[0] for r in df.select(text.build_text(df)).collect()] == ["a b", "b", "a", "b", ""]
    only = df.select("reviewText")
    assert [r[0] for r in only.select(text.build_text(only)).collect()] == ["b", "b", "", "b", ""]


def test_questions(one):
    values = {
        "Is this real leather": True,
        "CAN I return it": True,
        "this is thistle": False,
        "can it": False,
        "Will itch": False,
        "cani wear": False,
        "ok?": False,
        "ok ??  ": False,
        "aé is thisé": False,
        "well, is this?": True,
        None: False,
    }
    assert one(list(values), text.is_question) == list(values.values())


def test_preview(one):
    assert one(["x" * 120, "x" * 121], text.preview) == ["x" * 120, "x" * 120 + "..."]


def test_label_sentiment(one):
    values = ["5", "4", "4.0", "inf", "7", "3", "2", "1", "0", "-1", " 4 ", "+2."]
    values += ["3.5", "2.5", "NaN", None, "", "abc", "1,234", "1_000", "1d", "0x1p3"]
    assert one(values, labels.label_sentiment) == (
        ["Positive"] * 5 + ["Neutral"] + ["Negative"] * 4 + ["Positive", "Negative"] + [None] * 10
    )
    nan = float("nan")
    assert one([4.0, nan, None], labels.label_sentiment, "double") == ["Positive", None, None]
    assert one([True], labels.label_sentiment, "boolean") == ["Negative"]


def test_votes(one):
    assert one(["1,234", "7", "x", None], labels.parse_votes) == [1234.0, 7.0, None, None]


def test_thresholds(one):
    scores = [0.05, 0.049, -0.05, 0.0]
    assert one(scores, labels.threshold_label, "double") == [
        "Positive", "Neutral", "Negative", "Neutral",
    ]
    by_sign = one([0.01, -0.01, 0.0], lambda c: labels.threshold_label(c, 0.0, 0.0, True), "double")
    assert by_sign == ["Positive", "Negative", "Neutral"]


def test_calendar(spark):
    df = spark.createDataFrame([(1_000_000_000,)], "unixReviewTime bigint")
    row = labels.review_calendar(df).first()
    assert (row.date.isoformat(), row.month.isoformat(), row.month_of_year) == (
        "2001-09-09T01:46:40", "2001-09-01T00:00:00", 9,
    )


def test_clean_generated(one):
    values = {
        "Summary: a soft warm coat": "a soft warm coat",
        "Review: r1 Review: Summary: nice warm coat": "nice warm coat",
        "Summary: ok": "Summary: ok",
        "Soft. Summary: coat": "Soft. Summary: coat",
        f"{ECHO_MARKERS[0]} a quite short text": "a quite short text",
    }
    assert one(list(values), clean_generated) == list(values.values())


def test_echo(one):
    def completion(c):
        prompt = build_prompt(c, SUMMARY_PROMPT)
        return strip_echo(F.concat(prompt, F.lit("  done ")), prompt)

    assert one(["abc"], completion) == ["done"]
    assert one(["abc"], lambda c: strip_echo(F.lit(" free text "), F.col(c))) == ["free text"]


def test_terms(one):
    grams = one(["good coat a good shoe", "x", ""], lambda c: ngrams(tokens(F.col(c)), 1, 2))
    assert grams == [
        ["good", "coat", "good", "shoe", "good coat", "coat good", "good shoe"], [], [],
    ]
    counts = one(["b a b", ""], lambda c: count_terms(ngrams(tokens(F.col(c), 1), 1, 3)))
    assert [(r.term, r.tf) for r in counts[0]] == [
        ("a", 1), ("a b", 1), ("b", 2), ("b a", 1), ("b a b", 1),
    ]
    assert counts[1] == []
    with pytest.raises(ValueError):
        ngrams(F.array(), 2, 1)


def test_columns(spark):
    df = spark.range(1).selectExpr("id", "1 as b")
    assert select_existing(df, ["b", "c", "id"]).columns == ["b", "id"]
    with pytest.raises(KeyError, match="c, d"):
        require_columns(df, ["id", "c", "d"])


def test_row_local_functions_take_streams(spark, tmp_path):
    spark.createDataFrame([("Good  COAT", "5")], "reviewText string, overall string").write.json(
        str(tmp_path / "in")
    )
    stream = spark.readStream.schema("reviewText string, overall string").json(str(tmp_path / "in"))
    out = stream.select(
        text.clean_text("reviewText").alias("text"), labels.label_sentiment("overall").alias("s")
    )
    q = out.writeStream.format("memory").queryName("stream_out").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("stream_out").collect()] == [("good coat", "Positive")]
