import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlab.operators import frequencies, profile


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_percentiles(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "x int")
    d = profile.describe_lengths(df, ("x",)).first()
    assert (d["count"], d["mean"], d["min"], d["max"]) == (4, 4.0, 1.0, 10.0)
    assert round(d["std"], 4) == 4.0825
    assert [round(d[c], 4) for c in ("p50", "p75", "p90", "p95", "p99")] == [
        2.5, 4.75, 7.9, 8.95, 9.79,
    ]
    b = profile.iqr_bounds(df, "x").first()
    assert (b.q1, b.q3, b.lower, b.upper, b.outliers) == (1.75, 4.75, 0.0, 9.25, 1)
    assert rows(profile.length_outliers(df, "x")) == [(10,)]


def test_single_row_has_no_deviation(spark):
    assert profile.describe_lengths(spark.range(1), ("id",)).first()["std"] is None


@pytest.mark.parametrize(
    "values,bins,counts,edges",
    [
        ([1, 2, 2, 3, 10], 3, [4, 0, 1], [1, 4, 7, 10]),
        ([4, 4], 2, [0, 2], [3.5, 4, 4.5]),
    ],
)
def test_histogram(spark, values, bins, counts, edges):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = rows(profile.histogram(df, "x", bins), "bin")
    assert [r[3] for r in got] == counts
    assert [r[1] for r in got] + [got[-1][2]] == edges


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(0, "a"), (1, None), (2, None), (3, "A "), (4, "b")], "id int, text string"
    )
    assert profile.duplicate_text_count(df).first()[0] == 2
    flags = profile.flag_duplicates(df, ["text"], "id")
    assert [r.is_duplicate for r in flags.orderBy("id").collect()] == [
        False, False, True, False, False,
    ]
    assert profile.exact_duplicate_count(df, ("text",)).first()[0] == 1
    assert profile.exact_duplicate_count(df, ("absent",)).first()[0] == 0
    assert rows(profile.top_repeated_texts(df, k=1)) == [("a", 2)]


def test_repeated_texts_are_read_back_by_id(spark):
    texts = [(1, "A  b"), (2, "c"), (2, "a b"), (None, "d"), (None, "D"), (None, "d "), (3, ""), (4, None)]
    df = spark.createDataFrame(texts, "id long, text string")
    got = profile.top_repeated_texts(df, k=2, row_id="id")
    assert sorted(rows(got)) == [("a b", 2), ("d", 3)] == sorted(rows(profile.top_repeated_texts(df, k=2)))
    assert profile.top_repeated_texts(df.limit(0), row_id="id").count() == 0
    # Only the rows of the winning ids are normalised again: the second time is after the join.
    joined = got._jdf.queryExecution().executedPlan().toString().split("BroadcastHashJoin")
    assert "sha2" not in joined[1].split("BroadcastExchange")[0]


def test_majority_ties_go_to_the_first_label(spark):
    data = [("p", "Positive"), ("p", "Negative"), ("p", "Positive"), ("p", "Negative"),
            ("q", "Neutral"), ("r", None)]
    df = spark.createDataFrame(data, "k string, sentiment string")
    assert rows(profile.majority_label(df, "k"), "k") == [("p", "Negative", 4), ("q", "Neutral", 1)]


def test_activity_against_pandas(spark):
    keys = [f"k{i % 7 if i % 3 else 0}" for i in range(200)] + [None] * 5
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    counts = pd.Series(keys).value_counts()
    a = profile.activity_per_key(df, "k").first()
    assert (a.keys, a.mean, a.median, a["max"]) == (
        len(counts), counts.mean(), counts.median(), counts.max(),
    )
    curve = []
    for r in profile.rank_curve(df, "k").orderBy("first_rank").collect():
        curve += [r.reviews] * (r.last_rank - r.first_rank + 1)
    assert curve == counts.tolist()
    seg = profile.user_segments(df, "k", 20).first()
    assert seg.power_share == pytest.approx((counts > 20).mean())


def test_flag_with_nulls(spark):
    df = spark.createDataFrame(
        [(True, 1.0), (True, None), (True, 4.0), (False, None), (None, 5.0)],
        "verified boolean, overall double",
    )
    got = rows(profile.rating_by_flag(df), "verified")
    assert got == [(False, 0, None, None), (True, 2, 2.5, 2.5)]


def test_value_counts_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    got = rows(frequencies.value_counts(df, "x", normalize=True), "x")
    assert got == [("a", 2, pytest.approx(2 / 3)), ("b", 1, pytest.approx(1 / 3))]


def test_profile_of_nothing_and_of_optional_columns(spark):
    df = spark.createDataFrame(
        [(5.0, "Positive", "a b"), (3.0, "Neutral", "a  B"), (5.0, "Positive", "")]
        + [(5.0, "Positive", "a b")],
        "overall double, sentiment string, text string",
    )
    r = profile.profile_report(df).first()
    assert (r.subset_rows, r.unique_products) == (4, 0)
    assert (r.duplicate_normalized_text_count, r.exact_duplicate_count) == (2, 1)
    assert r.rating_distribution == {"3.0": 1, "5.0": 3}
    assert r.sentiment_distribution.asDict() == {"Positive": 3, "Neutral": 1, "Negative": 0}
    assert r.reviews_per_user.asDict() == {"mean": 0.0, "median": 0.0, "max": 0}
    empty = profile.profile_report(df.filter(F.lit(False))).first()
    assert (empty.subset_rows, empty.average_rating, empty.outlier_review_count) == (0, 0.0, 0)
    assert empty.outlier_thresholds_iqr.asDict() == {"lower": 0.0, "upper": 0.0}


def test_funnel(spark):
    raw = spark.createDataFrame(
        [("5", "fine"), ("5", "http://only.url"), ("2.5", "x"), (None, "y"), ("1", "bad")],
        "overall string, reviewText string",
    )
    assert tuple(profile.funnel(raw).first()) == (5, 3, 2, 1, 0, 1)
