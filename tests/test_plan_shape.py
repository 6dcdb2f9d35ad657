"""What the planner makes of the queries."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON = {"generate_errors", "generate_fallback", "generate_summaries", "reply_questions", "smote"}
EAGER = {"logreg_holdout", "svm_holdout", "grid_search", "cv_results", "evaluate_models"}
SCALARS = ["activity_per_user", "describe_lengths", "profile_report", "funnel", "row_split",
           "folds", "quota_sample", "flag_duplicates", "top_repeated_texts", "vocabulary",
           "tfidf_long", "lexicon_compound", "majority_label", "rank_curve", "confusion",
           "summarize_long", "leakage_report"]


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SCALARS)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(spark, name)
    assert not re.search(r"PythonUDF|InPandas|ArrowEval|BatchEvalPython", text)
    assert "CartesianProduct" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "activity_per_user")
    assert re.search(r"ReadSchema: struct<o_custkey:bigint>", text)
    text = plan(spark, "row_split")
    assert "o_totalprice" not in text


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_products")
    assert "TakeOrderedAndProject" in plan(spark, "vocabulary")


def test_duplicates_are_not_gathered_in_a_window(spark):
    assert "Window" not in plan(spark, "flag_duplicates")
