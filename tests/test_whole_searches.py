"""Searches see every training row, and softmax problems solved by single tasks are the same."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.operators import classify, linear
from reviewlab.queries import models
from reviewlab.sources.stages import materialize


@pytest.mark.parametrize("kind", ["logreg", "svm"])
def test_a_search_gets_all_training_rows(spark, monkeypatch, kind):
    split = spark.range(20_100).select(
        F.col("id").alias("review_id"), (F.col("id") % 3).cast("double").alias("label"),
        F.when(F.col("id") % 3 == 0, "Negative").when(F.col("id") % 3 == 1, "Neutral")
        .otherwise("Positive").alias("sentiment"), F.lit("train").alias("split"),
    )
    seen = []

    def spy(train, *args, **named):
        seen.append(train.select("review_id").distinct().count())
        return None, None

    monkeypatch.setattr(models, "_row_split", lambda *a: split)
    monkeypatch.setattr(classify, "grid_search", spy)
    models._new_search(spark, "", kind)
    assert seen == [20_100]


def test_products_of_prepared_rows_match_a_dense_matrix():
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(60, 40)) * (rng.random((60, 40)) < np.linspace(0.0, 0.3, 40))
    dense[7] = 0.0
    rows, indices = np.nonzero(dense)
    row = {"block": 1, "rows": 60, "ends": np.cumsum(np.bincount(rows, minlength=60)).astype(np.int64).tobytes(),
           "indices": indices.astype(np.int32).tobytes(), "weights": dense[rows, indices].tobytes()}
    for c in ("labels", "folds", "only"):
        row[c] = np.zeros(60, np.int32).tobytes()
    block, full = linear.Block(row), np.hstack((dense, np.ones((60, 1))))
    products = linear.Products(block, 41)
    assert 0 < len(products.common) < 40
    for columns in (2, 9):
        w, v = rng.normal(size=(41, columns)), rng.normal(size=(60, columns))
        assert np.allclose(products.dot(w), full @ w)
        assert np.allclose(products.transposed_dot(v, 41), full.T @ v)


def test_tasks_that_hold_all_rows_need_no_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [0, 1 + i % 4], [float(rng.normal() + i % 3), 1.0], i % 3, i // 3 % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, a array<int>, v array<double>, y int, fold int")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(5).alias("size"),
                      F.col("a").alias("indices"), F.col("v").alias("values"))
    df = df.select(vector.alias("features"), F.col("y").cast("double").alias("label"), "fold")
    df = materialize(df.repartition(3), "alone", ["features"])
    estimator = classify.PenalisedLogisticRegression()
    packed = estimator._packed(df, "fold", rows_per_task=100)
    asked = [({"C": c, "maxIter": n}, f) for c in (0.1, 1.0, 3.0) for f in range(3) for n in (2, 1000)]
    passes, sums = [], linear._sums
    monkeypatch.setattr(linear, "_sums", lambda *a: passes.append(1) or sums(*a))
    alone = estimator.solve(packed, asked)
    assert not passes
    monkeypatch.setattr(linear, "TASK_ENTRIES", 0)
    together = estimator.solve(packed, asked)
    near = estimator.solve(packed, asked[-1:], together[-1].coefficients)[0]
    packed.close()
    assert passes and near.iterations < 3 and near.converged
    # Two points with a gradient of GRADIENT are this far apart where the penalty alone bends the loss.
    for (given, _), a, b in zip(asked, alone, together):
        assert a.converged and b.converged
        if given["maxIter"] == 1000:
            apart = 2 * linear.GRADIENT * given["C"] * 200
            assert np.abs(a.coefficients - b.coefficients).max() <= apart
        else:
            assert np.allclose(a.coefficients, b.coefficients, atol=1e-6)
