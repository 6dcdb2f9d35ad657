"""The three flows end to end, on reviews made from the given documents."""

import json
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reviewlab.operators import sampling
from reviewlab.plans import flows
from reviewlab.plans.prepare import RunCounts, prepare_reviews
from reviewlab.queries import views as v
from reviewlab.sources.stages import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return v.labeled_docs(spark, SF).select(
        "review_id",
        F.col("overall").cast("string").alias("overall"),
        F.lit("Summary line").alias("summary"),
        F.col("text").alias("reviewText"),
        "asin",
        F.col("lang").alias("reviewerID"),
    )


def test_flows(spark, raw, tmp_path):
    out = str(tmp_path)
    metrics = flows.lexicon_evaluation(raw, v.lexicon(spark), f"{out}/lexicon", n=60)
    assert {r.model for r in metrics.collect()} == {"compound_pred", "polarity_pred"}

    subset = flows.subset_and_profile(raw, f"{out}/one", n=80)
    assert subset.count() == 80
    report = json.loads(next((tmp_path / "one" / "profile").glob("part-*.json")).read_text())
    assert report["subset_rows"] == 80 and report["unique_users"] == 4
    steps = spark.read.csv(f"{out}/one/subset_report", header=True)
    steps = {(r.measure, r.value): int(r.n) for r in steps.collect()}
    assert steps["rows_loaded", None] == raw.count() and steps["subset_rows", None] == 80
    assert sum(n for (measure, _), n in steps.items() if measure == "rating") == 80
    left = prepare_reviews(raw).groupBy("sentiment").count().collect()
    assert steps["rows_with_text", None] == sum(r["count"] for r in left)

    features = flows.build_features(subset, f"{out}/two", max_features=200, ngram=(1, 1))
    assert features.count() == 80 and "overall" in features.columns
    models = {}
    grid = {"C": [1.0], "classWeight": ["none", "balanced"], "maxIter": [10]}
    for kind, split in (("logreg", "group"), ("svm", "row")):
        models[kind] = flows.train_classifier(
            features, f"{out}/{kind}", kind, split, k=2, use_smote=kind == "logreg", grid=grid
        )
        tested = spark.read.parquet(f"{out}/{kind}/test_predictions").count()
        summary = spark.read.json(f"{out}/{kind}/training_summary").first()
        assert tested == summary.test_rows > 0
        assert summary.train_rows + summary.test_rows == summary.total_rows
        assert set(summary.best_params.asDict()) == set(grid) and 0 <= summary.best_cv_f1_macro <= 1
    leak = spark.read.parquet(f"{out}/logreg/leakage")
    assert leak.filter("key_name = 'asin'").first().shared_keys == 0

    sample = spark.read.parquet(f"{out}/lexicon/sample")
    vocabulary = spark.read.parquet(f"{out}/two/vocabulary")
    compared = flows.compare_on_sample(
        sample, vocabulary, {**models, "none": None}, f"{out}/compare", (1, 1)
    ).collect()
    assert {r.model for r in compared} == {
        "compound_pred", "polarity_pred", "logreg", "svm", "none",
    }
    assert [r.error for r in compared if r.model == "none"] == ["model not found"]
    sizes = spark.read.csv(f"{out}/compare/test_set", header=True).collect()
    assert sum(int(r.n) for r in sizes) == sample.count()

    status = flows.ratings_and_replies(subset, f"{out}/three", vocabulary)
    got = {r.step: r.status for r in status.collect()}
    assert got["ratings"] == "ok" and got["summaries"] == "ok"
    # Without a question among the texts the last part reports an error and stops nothing.
    assert got["replies"] in ("ok", "error")


def test_counts_come_from_the_write(spark, raw, tmp_path):
    counts = RunCounts()
    mixed = raw.union(raw.withColumns({"overall": F.lit("none")})).union(
        raw.withColumns({"summary": F.lit(None).cast("string"), "reviewText": F.lit("")})
    )
    with stored(prepare_reviews(mixed, counts=counts)) as prepared:
        n = raw.count()
        assert counts.get() == {
            "rows_loaded": 3 * n, "rows_labelled": 2 * n, "rows_with_text": prepared.count(),
        }
        path = prepared.inputFiles()[0].rsplit("/", 1)[0]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)

    counts = RunCounts()
    with stored(prepare_reviews(raw.limit(0), counts=counts)) as prepared:
        assert prepared.count() == 0 and set(counts.get().values()) == {0}


def test_the_draw_reads_stored_rows(spark, raw, tmp_path):
    """The text is cleaned before the rows are stored, and read once by the draw."""
    with stored(prepare_reviews(raw), "prepared") as prepared:
        plan = sampling.stratified_subset(prepared, 50, "review_id")._jdf.queryExecution()
        text = plan.optimizedPlan().toString()
        assert "regexp_replace" not in text
        scans = re.findall(r"ReadSchema: (\S+)", plan.executedPlan().toString())
        assert sum("text" in s for s in scans) == 1
