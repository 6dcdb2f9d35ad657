"""The registered searches run as they are, and the solvers behind them reach the optimum."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

import __spark_entry__ as entry
from reviewlab.operators import classify, linear
from reviewlab.queries import models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cloud(spark):
    """Overlapping sparse rows of three classes, in three partitions, dealt to three folds."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        label = int(rng.integers(0, 3)) if i % 5 else 0
        at = np.sort(rng.choice(40, 8, replace=False))
        x = rng.random(8) + (at % 3 == label) * 0.8
        rows.append((i, float(label), i % 3, Vectors.sparse(40, at.tolist(), (x / np.linalg.norm(x)).tolist())))
    kind = T.StructType([
        T.StructField("row_id", T.LongType()), T.StructField("label", T.DoubleType()),
        T.StructField("fold", T.IntegerType()), T.StructField("features", VectorUDT()),
    ])
    return spark.createDataFrame(rows, kind).repartition(3, "row_id").persist()


def _counts_and_blocks(cloud, folds=3):
    blocks = linear.pack_rows(cloud, "features", "label", "fold").persist()
    return blocks, linear.class_counts(blocks, 3, folds)


def test_whole_searches(spark):
    run = entry.queries()
    assert run["grid_search"](spark, SF).count() == run["svm_grid_search"](spark, SF).count() > 0
    rows = run["cv_results"](spark, SF).collect()
    assert len(rows) == 16 and all(0 <= r.mean_test_score <= 1 for r in rows)
    # Both limits on iterations lie beyond convergence.
    scores = {(r.param_C, r.param_classWeight): set() for r in rows}
    for r in rows:
        scores[r.param_C, r.param_classWeight].add(r.mean_test_score)
    assert len(scores) == 8 and all(len(s) == 1 for s in scores.values())


def test_the_bound_on_rows(spark, monkeypatch):
    seen = []

    def spy(train, *args, **named):
        seen.append(train.count())
        raise InterruptedError

    monkeypatch.setattr(models, "SEARCH_ROWS", 40)
    monkeypatch.setattr(models, "_SEARCHED", {})
    monkeypatch.setattr(classify, "grid_search", spy)
    with pytest.raises(InterruptedError):
        entry.queries()["svm_grid_search"](spark, SF)
    assert seen == [40]


@pytest.mark.parametrize("balanced", [False, True])
def test_softmax_equals_the_library_of_spark(spark, cloud, balanced):
    weight = F.lit(1.0)
    if balanced:
        sizes = {r.label: r["count"] for r in cloud.groupBy("label").count().collect()}
        for c, n in sizes.items():
            weight = F.when(F.col("label") == c, 240 / (3 * n)).otherwise(weight)
    theirs = LogisticRegression(
        family="multinomial", standardization=False, regParam=1 / (3.0 * 240), maxIter=500,
        tol=1e-12, weightCol="w",
    ).fit(cloud.withColumn("w", weight))
    ours = classify.PenalisedLogisticRegression(C=3.0, classWeight="balanced" if balanced else "none").fit(cloud)
    assert ours.fitted.converged
    np.testing.assert_allclose(ours.coefficients[:-1].T, theirs.coefficientMatrix.toArray(), atol=1e-3)
    bias = ours.coefficients[-1] - ours.coefficients[-1].mean()
    np.testing.assert_allclose(bias, theirs.interceptVector.toArray(), atol=1e-3)


def test_pairs_equal_the_library_of_spark(spark, cloud):
    ours = classify.PairwiseLinearSVC(C=1.0).fit(cloud)
    assert ours.fitted.converged and ours.fitted.certificate <= linear.GAP
    scored = ours.transform(cloud)
    dense = {r.row_id: r.features.toArray() for r in cloud.collect()}
    for k, (low, high) in enumerate(ours.pairs):
        pair = cloud.filter(F.col("label").isin(low, high)).withColumn("y", (F.col("label") == high).cast("double"))
        theirs = LinearSVC(
            regParam=1 / pair.count(), standardization=False, maxIter=2000, tol=1e-10, labelCol="y"
        ).fit(pair)
        own = ours.coefficients[:, k]
        theirs = np.append(theirs.coefficients.toArray(), theirs.intercept)
        x = np.array([dense[r.row_id] for r in pair.collect()])
        y = np.array([1.0 if r.y else -1.0 for r in pair.collect()])

        def loss(c):
            return 0.5 * c[:-1] @ c[:-1] + np.maximum(0, 1 - y * (x @ c[:-1] + c[-1])).sum()

        assert loss(own) <= loss(theirs) * (1 + linear.GAP)
        mine, other = (x @ c[:-1] + c[-1] for c in (own, theirs))
        clear = np.abs(other) > 0.2
        assert ((mine > 0) == (other > 0))[clear].all()
    assert scored.count() == 240


def test_many_problems_equal_single_ones(spark, cloud):
    """Folds as masks, several partitions and problems side by side change nothing."""
    blocks, counts = _counts_and_blocks(cloud)
    problems = [linear.Problem(c, b, f) for c, b, f in ((0.1, True, 0), (3.0, False, 2))]
    together = linear.fit_softmax(blocks, problems, [1000], counts, 40)
    for p, fit in zip(problems, together):
        own = cloud.filter(F.col("fold") != p.held)
        alone = classify.PenalisedLogisticRegression(
            C=p.C, classWeight="balanced" if p.balanced else "none"
        ).fit(own)
        np.testing.assert_allclose(fit.coefficients[:-1], alone.coefficients[:-1], atol=2e-3)


def test_updates_of_several_tasks_add_up(spark, cloud):
    blocks, counts = _counts_and_blocks(cloud)
    assert linear.tasks_of(blocks) == 3
    problem = linear.Problem(0.1, True, 1, (0, 2))
    gaps = [linear.fit_hinge(blocks, [problem], n, counts, 40)[0].certificate for n in (1, 8)]
    assert -1e-9 <= gaps[1] < 0.5 * gaps[0]


def test_iteration_limits_and_scores(spark, cloud):
    blocks, counts = _counts_and_blocks(cloud)
    fit = linear.fit_softmax(blocks, [linear.Problem(10.0, False, 1)], [3, 1000], counts, 40)[0]
    assert set(fit.at) == {3} and fit.iterations > 3
    cells = linear.held_out_cells(blocks, [(1, fit.coefficients)], 3)
    model = classify.LinearModel(fit.coefficients, [0.0, 1.0, 2.0])
    held = model.transform(cloud.filter("fold = 1")).groupBy("label", "prediction").count().collect()
    assert {(r.label, r.prediction): r["count"] for r in held} == {
        (float(t), float(p)): n for (t, p), n in np.ndenumerate(cells[0]) if n
    }


def test_certificates_know_an_unfinished_fit(spark, cloud):
    good = classify.PenalisedLogisticRegression(C=1.0)
    short = classify.PenalisedLogisticRegression(C=1.0, maxIter=2)
    measures = [classify.certificates(cloud, e, [{}]).first() for e in (good, short)]
    assert measures[0].measure <= 2 * linear.GRADIENT and measures[0].n_rows == 240
    assert measures[1].measure > 1e-4
    gap = classify.certificates(cloud, classify.PairwiseLinearSVC(C=1.0), [{}]).first().measure
    assert -1e-9 <= gap <= 2 * linear.GAP


def test_one_class_and_a_wrong_label(spark, cloud):
    one = cloud.filter("label = 0")
    for estimator in (classify.PenalisedLogisticRegression(), classify.PairwiseLinearSVC()):
        assert {r.prediction for r in estimator.fit(one).transform(cloud).collect()} == {0.0}
    with pytest.raises(ValueError, match="values"):
        classify.PenalisedLogisticRegression(labelCol="row_id").fit(cloud)
