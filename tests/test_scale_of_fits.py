import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlab.functions.text import word_count
from reviewlab.operators import generate, linear, smote, summarize, tfidf


def _block(rng, n=50, width=40):
    lengths = rng.integers(0, 9, n)
    indices = np.concatenate([np.sort(rng.choice(width, k, False)) for k in lengths]).astype(np.int32)
    values = rng.normal(size=len(indices))
    row = {"block": 1, "rows": n, "ends": np.cumsum(lengths).astype(np.int64).tobytes(),
           "indices": indices.tobytes(), "weights": values.tobytes()}
    for c in ("labels", "folds", "only"):
        row[c] = np.zeros(n, np.int32).tobytes()
    dense = np.zeros((n, width + 1))
    dense[np.repeat(np.arange(n), lengths), indices] = values
    dense[:, -1] = 1.0
    return linear.Block(row), dense


def test_products_of_a_block_match_a_dense_matrix():
    rng = np.random.default_rng(3)
    block, dense = _block(rng)
    w, v = rng.normal(size=(41, 5)), rng.normal(size=(50, 5))
    assert np.allclose(block.dot(w), dense @ w)
    assert np.allclose(block.transposed_dot(v, 41), dense.T @ v)


def test_entries_of_some_rows_match_a_dense_matrix():
    rng = np.random.default_rng(4)
    block, dense = _block(rng)
    dense, keep, v, w = dense[:, :-1], rng.random(50) < 0.5, rng.normal(size=50), rng.normal(size=40)
    rows = linear.Entries(block.rows_of_entries().astype(np.int32), block.indices, block.values, 50, 40)
    assert np.allclose(rows.dot(w), dense @ w) and np.allclose(rows.transposed_dot(v), dense.T @ v)
    some = rows.only(keep)
    assert np.allclose(some.dot(w), dense[keep] @ w)
    assert np.allclose(some.transposed_dot(v[keep]), dense[keep].T @ v[keep])


def test_balanced_values_stay_in_the_box_and_add_up():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sides, upper = rng.choice([-1.0, 1.0], 30), rng.random(30) + 0.1
        sides[:2] = 1.0, -1.0
        got = linear._balanced(rng.normal(size=30) * 5, sides, upper, 0.0)
        assert abs(sides @ got) < 1e-9 and (got >= 0).all() and (got <= upper).all()


def test_near_copies_of_both_classes_are_told_apart(spark):
    from reviewlab.operators.classify import PairwiseLinearSVC

    # Each row has a near copy in another class: the dual variables are nearly dependent.
    rng = np.random.default_rng(8)
    x = np.abs(rng.normal(size=(150, 200))) * (rng.random((150, 200)) < 0.1)
    x = np.concatenate((x, x + 0.02 * rng.normal(size=x.shape) * (x > 0)))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    y = np.concatenate((np.arange(150) % 3, (np.arange(150) + 1) % 3))
    # Kept as stored vectors are: without zeros, a row may have none.
    rows = [([int(i) for i in np.flatnonzero(r)], [float(v) for v in r[r != 0]], float(c)) for r, c in zip(x, y)]
    df = spark.createDataFrame(rows, "i array<int>, v array<double>, label double")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(200).alias("size"),
                      F.col("i").alias("indices"), F.col("v").alias("values"))
    from reviewlab.sources.stages import materialize

    df = materialize(df.select(vector.alias("features"), "label"), "copies", ["features"])
    fit = PairwiseLinearSVC(C=1000.0, classWeight="balanced", maxIter=20).fit(df).fitted
    assert fit.converged and fit.certificate <= linear.GAP
    for k, (low, high) in enumerate([(0, 1), (0, 2), (1, 2)]):
        inside = (y == low) | (y == high)
        side, weight = np.where(y[inside] == high, 1.0, -1.0), 1000.0 * (300 / (3 * np.bincount(y)))[y[inside]]
        w = fit.coefficients[:, k]
        value = 0.5 * w[:-1] @ w[:-1] + weight @ np.maximum(0, 1 - side * (x[inside] @ w[:-1] + w[-1]))
        assert fit.bounds[k] <= value <= fit.bounds[k] * (1 + 2 * linear.GAP)


def test_tasks_without_blocks_are_not_counted(spark):
    # One row in one of six partitions.
    rows = spark.range(0, 6, 1, 6).filter("id = 4")
    assert linear.tasks_of(rows) == 6 and linear.tasks_with_rows(rows) == 1


def test_few_softmax_problems_are_held_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [0, 1], [float(rng.normal() + i % 2), 1.0], i % 2, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, a array<int>, v array<double>, y int, fold int")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(2).alias("size"),
                      F.col("a").alias("indices"), F.col("v").alias("values"))
    from reviewlab.operators.classify import PenalisedLogisticRegression
    from reviewlab.sources.stages import materialize

    df = materialize(df.select(vector.alias("features"), F.col("y").cast("double").alias("label"), "fold"),
                     "few", ["features"])
    estimator = PenalisedLogisticRegression()
    packed = estimator._packed(df, "fold")
    asked = [({"C": c}, f) for c in (0.1, 1.0, 3.0) for f in range(3)]
    together = estimator.solve(packed, asked)
    widths, sums = [], linear._sums
    monkeypatch.setattr(linear, "_sums", lambda b, w, shape, t: widths.append(shape[1]) or sums(b, w, shape, t))
    monkeypatch.setattr(linear, "LANES", 1)
    # Room for two states: of 3 coefficients by 2 classes with their history.
    monkeypatch.setattr(linear, "HELD_BYTES", 2 * 6 * 8 * (2 * linear.HISTORY + 6))
    apart = estimator.solve(packed, asked)
    packed.close()
    assert max(widths) == 4 and all(f.converged for f in apart)
    for a, b in zip(together, apart):
        assert np.allclose(a.coefficients, b.coefficients, atol=1e-4)


@pytest.mark.parametrize("dense", [True, False])
def test_block_neighbours_of_dense_and_sparse_points(dense, monkeypatch):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(60, 7)), 1)
    x[20:30] = x[0]
    points = pd.DataFrame({
        "_class": "a", "_id": [str(i) for i in range(60)], "_hash": rng.integers(0, 1 << 60, 60),
        "_i": [np.arange(7)] * 60, "_v": list(x),
    })
    used = []
    monkeypatch.setattr(smote, "DENSE", 0.25 if dense else 2.0)
    kept = smote.Matrix.dots
    monkeypatch.setattr(smote.Matrix, "dots", lambda *a: used.append(1) or kept(*a))
    got = smote._block_neighbours(4)(points, points)
    assert bool(used) == dense
    h = points["_hash"].to_numpy()
    for q in range(60):
        d = np.round(((x - x[q]) ** 2).sum(1), 9)
        want = sorted((d[j], (h[j] - h[q]) % (1 << 60), str(j)) for j in range(60) if j != q)[:4]
        assert got[got["_q"] == str(q)]["_nb"].tolist() == [w[2] for w in want]


def test_generated_rows_come_in_small_parts(spark):
    schema = "id long, text string, xs array<int>"
    df = spark.createDataFrame([(i, None if i == 7 else f" t{i} ", [i]) for i in range(700)], schema)

    def numbered():
        calls = []

        def run(text):
            calls.append(text)
            return f"{text.strip()}"
        return run

    got = generate.generate(df.coalesce(1), "text", numbered).collect()
    assert len(got) == 700 and all(r.generated == f"t{r.id}" and r.xs == [r.id] for r in got if r.id != 7)
    assert [r.id for r in got if r.error] == [7]


def test_entries_without_words_have_the_same_weights(spark):
    rows = spark.createDataFrame([(1, "aa bb aa cc"), (2, "bb dd"), (3, "zz")], "row_id int, text_norm string")
    terms = tfidf.row_terms(rows, "row_id", ngram=(1, 1))
    vocabulary = tfidf.fit_vocabulary(terms, min_df=1, max_df=1.0)
    full = {r.row_id: r.entries for r in tfidf.tfidf_rows(terms, vocabulary).collect()}
    lean = {r.row_id: r.entries for r in tfidf.tfidf_rows(terms, vocabulary, words=False).collect()}
    assert set(full) == {1, 2, 3}
    for k in full:
        assert [(e.term_id, e.weight) for e in full[k]] == [tuple(e) for e in lean[k]]


def test_parts_of_summaries_follow_the_texts(spark, monkeypatch):
    monkeypatch.setattr(summarize, "TEXTS_PER_TASK", 2)
    text = " ".join(f"word{i} again here." for i in range(60))
    df = spark.createDataFrame([(i, text) for i in range(60)], "review_id int, text string")
    vocabulary = spark.createDataFrame([("again", 1.0)], "term string, idf double")
    out = summarize.summarize_long(df, vocabulary, n=None)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    stated = re.findall(r"RepartitionByExpression \[review_id#\d+L?\], (\d+)", plan)
    assert stated and {int(n) for n in stated} == {max(30, least)}
    got = out.withColumn("n", word_count("generated_summary")).collect()
    assert len(got) == 60 and all(0 < r.n <= 50 for r in got)


def test_certificates_join_an_entry_once_for_all_candidates(spark, monkeypatch):
    from reviewlab.operators import classify
    from reviewlab.sources.stages import materialize

    rng = np.random.default_rng(9)
    rows = [(i, [0, 2], [float(rng.normal() + i % 3), 1.0], float(i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id int, i array<int>, v array<double>, label double")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(3).alias("size"),
                      F.col("i").alias("indices"), F.col("v").alias("values"))
    df = materialize(df.select("row_id", vector.alias("features"), "label"), "few", ["features"])
    joined, join = [], classify.lookup_join
    monkeypatch.setattr(classify, "lookup_join", lambda *a: joined.append(out := join(*a)) or out)
    maps = [{"C": c} for c in (0.1, 1.0, 10.0)]
    estimator = classify.PairwiseLinearSVC()
    found = {r.candidate: r for r in classify.certificates(df, estimator, maps).collect()}
    assert set(found) == {0, 1, 2} and all(r.n_rows == 90 and r.measure <= 2e-4 for r in found.values())
    # Every entry meets the coefficients of all 9 columns in one row.
    assert sum(t.count() for t in joined) == 180
