from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from reviewlab.operators import classify
from reviewlab.operators.smote import class_neighbours, neighbour_count, smote
from reviewlab.functions.hashing import seeded_hash
from reviewlab.sources.stages import materialize

VECTORS = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("features", VectorUDT()),
    ]
)


@pytest.fixture(scope="module")
def points(spark):
    """Three separable clouds: 40 Positive, 12 Neutral, 9 Negative, some of them copies."""
    rng = np.random.default_rng(0)
    rows = []
    for label, center, n in (("Positive", 0, 40), ("Neutral", 6, 12), ("Negative", -6, 9)):
        for i in range(n):
            x = np.round(rng.normal(center, 1.0, 4), 3)
            if i % 4 == 1:
                x = np.full(4, float(center))
            rows.append((f"{label[:3]}{i}", label, Vectors.sparse(6, [0, 2, 3, 5], x.tolist())))
    return spark.createDataFrame(rows, VECTORS).persist()


def test_neighbours_match_brute_force(spark, points):
    stored = F.unwrap_udt("features")
    table = points.select(
        F.col("sentiment").alias("_class"),
        F.col("row_id").alias("_id"),
        seeded_hash("row_id", 1).alias("_hash"),
        stored["indices"].alias("_i"),
        stored["values"].alias("_v"),
    )
    sizes = {"Positive": 40, "Neutral": 12, "Negative": 9}
    got = class_neighbours(table, table, sizes, 3, block_rows=5).collect()
    dense = {r.row_id: (r.sentiment, r.features.toArray()) for r in points.collect()}
    chosen = {}
    for r in got:
        chosen.setdefault(r._q, []).append(r._nb)
    assert set(chosen) == set(dense) and all(len(set(c)) == 3 for c in chosen.values())
    for q, (label, x) in dense.items():
        others = sorted(
            round(float(np.sum((x - y) ** 2)), 6)
            for k, (other, y) in dense.items()
            if other == label and k != q
        )
        mine = sorted(round(float(np.sum((x - dense[k][1]) ** 2)), 6) for k in chosen[q])
        assert q not in chosen[q] and mine == pytest.approx(others[:3])


def test_smote_balances_on_segments(points):
    raised = smote(points, "sentiment", "row_id", block_rows=5).collect()
    assert Counter(r.sentiment for r in raised) == {"Positive": 40, "Neutral": 40, "Negative": 40}
    dense = {r.row_id: r.features.toArray() for r in raised if not r.synthetic}
    assert len(dense) == 61
    used = Counter()
    for r in raised:
        if r.synthetic:
            x, nb, new = dense[r.base_id], dense[r.neighbour_id], r.features.toArray()
            length = np.linalg.norm(nb - x)
            assert np.linalg.norm(new - x) + np.linalg.norm(nb - new) == pytest.approx(length)
            used[r.base_id] += 1
    # 28 extra rows over 12 bases, 31 over 9: turns differ by at most one.
    assert {used[f"Neu{i}"] for i in range(12)} == {2, 3}
    assert {used[f"Neg{i}"] for i in range(9)} == {3, 4}
    again = smote(points.repartition(7), "sentiment", "row_id", block_rows=5).collect()
    assert sorted((r.row_id, tuple(np.round(r.features.toArray(), 9))) for r in again) == sorted(
        (r.row_id, tuple(np.round(r.features.toArray(), 9))) for r in raised
    )


def test_smote_limits(spark, points):
    assert [neighbour_count(n) for n in (2, 6, 7, 50)] == [1, 5, 5, 5]
    lone = points.filter("sentiment = 'Positive'").unionByName(
        points.filter("sentiment = 'Negative'").orderBy("row_id").limit(1)
    )
    with pytest.warns(UserWarning, match="skipped"):
        assert smote(lone, "sentiment", "row_id").count() == 41
    two = points.filter("sentiment = 'Positive'").unionByName(
        points.filter("sentiment = 'Negative'").orderBy("row_id").limit(2)
    )
    assert smote(two, "sentiment", "row_id").count() == 80


def test_class_weights(points):
    got = {r.sentiment: r.weight for r in classify.class_weights(points).collect()}
    assert got["Positive"] == pytest.approx(61 / (3 * 40))


@pytest.mark.parametrize("kind", ["logreg", "svm"])
def test_classifiers_separate_the_clouds_and_survive_storage(spark, points, tmp_path, kind):
    rows = classify.with_class_index(points)
    if kind == "logreg":
        estimator = classify.PenalisedLogisticRegression(C=1.0, maxIter=50)
    else:
        estimator = classify.PairwiseLinearSVC(C=1.0, classWeight="balanced", maxIter=20)
    model = estimator.fit(rows)
    predicted = classify.predict(rows, model)
    assert predicted.filter("y_true = y_pred").count() == 61
    path = str(tmp_path / "model")
    classify.save_model(model, path)
    loaded = classify.load_model(spark, path)
    assert {tuple(r) for r in classify.predict(rows, loaded).collect()} == {
        tuple(r) for r in predicted.collect()
    }


def test_grid_search_ranks_and_refits(spark, points):
    rows = classify.with_class_index(points).withColumn(
        "fold", (F.abs(F.hash("row_id")) % 2).cast("int")
    )
    rows = materialize(rows, "folds")
    fitted, candidates = classify.grid_search(
        rows, classify.PenalisedLogisticRegression(),
        {"C": [1e-7, 1.0], "maxIter": [20]}, k=2, oversample="row_id",
    )
    table = classify.cv_results(spark, fitted, candidates)
    best = table.filter("rank_test_score = 1").first()
    assert best.param_C == "1.0" and best.mean_test_score > 0.9
    assert table.count() == 2
    assert fitted.bestModel.transform(rows).count() == 61


def test_equal_scores_share_a_rank(spark):
    scores = spark.createDataFrame(
        [(0, 0.5), (1, 0.9), (2, 0.9)], "candidate int, mean_test_score double"
    )
    ranks = [(r.candidate, r.rank_test_score) for r in classify.rank_candidates(scores).collect()]
    assert ranks == [(1, 1), (2, 1), (0, 3)]


def test_grids():
    estimator = classify.PenalisedLogisticRegression()
    assert len(classify.param_maps(estimator, classify.LOGREG_GRID)) == 16
    assert len(classify.param_maps(classify.PairwiseLinearSVC(), classify.SVM_GRID)) == 6
