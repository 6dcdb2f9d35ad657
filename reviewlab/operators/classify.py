"""Linear classifiers, their tuning and their evaluation."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace
from itertools import combinations, product

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from reviewlab.operators import linear
from reviewlab.operators.evaluate import classification_metrics, confusion_matrix
from reviewlab.operators.joins import lookup_join
from reviewlab.operators.linear import Fit, Problem
from reviewlab.operators.smote import smote
from reviewlab.schema import CLASS_ORDER
from reviewlab.sources.stages import materialize, remove_stage, stage_path

# The search grids.
LOGREG_GRID = {
    "C": [0.1, 1.0, 3.0, 10.0],
    "classWeight": ["none", "balanced"],
    "maxIter": [500, 1000],
}
SVM_GRID = {"C": [0.1, 1.0, 10.0], "classWeight": ["none", "balanced"]}


def with_class_index(df: DataFrame, label: str = "sentiment", out: str = "label") -> DataFrame:
    """Add the class number, classes in alphabetical order."""
    index = F.lit(None).cast("double")
    for i, name in enumerate(CLASS_ORDER):
        index = F.when(F.col(label) == name, F.lit(float(i))).otherwise(index)
    return df.withColumn(out, index)


def class_name(index: Column) -> Column:
    """The class of a class number."""
    return F.get(F.array(*[F.lit(c) for c in CLASS_ORDER]), index.cast("int"))


def class_weights(df: DataFrame, label: str = "sentiment") -> DataFrame:
    """``(label, n, weight)`` with the balanced weight N / (classes * n)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    return counts.withColumn(
        "weight",
        F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n")),
    )


#: Classes a classifier may have; more point to a wrong label column.
MAX_CLASSES = 100


class _Regularised(Params):
    """Parameters of a classifier whose penalty is stated as inverse strength ``C``."""

    C = Param(Params._dummy(), "C", "inverse penalty strength", TypeConverters.toFloat)
    classWeight = Param(
        Params._dummy(), "classWeight", "'none' or 'balanced'", TypeConverters.toString
    )

    def _problem(self, given: dict | None = None, held: int | None = None, pair=None) -> Problem:
        given = given or {}
        balanced = given.get("classWeight", self.getOrDefault(self.classWeight)) == "balanced"
        return Problem(given.get("C", self.getOrDefault(self.C)), balanced, held, pair)

    #: Training rows one task of a single fit should have at least.
    rows_per_task = linear.ROWS_PER_TASK

    def _packed(self, dataset: DataFrame, fold: str | None = None, only: str | None = None,
                rows_per_task: int = linear.ROWS_PER_TASK):
        names = self.getFeaturesCol(), self.getLabelCol()
        return Packed(dataset, *names, fold, only, rows_per_task)


class Packed:
    """Stored blocks of a training table, with its classes and sizes."""

    def __init__(self, dataset: DataFrame, features: str, label: str, fold=None, only=None,
                 rows_per_task: int = linear.ROWS_PER_TASK):
        labelled = dataset.filter(F.col(label).isNotNull())
        found = labelled.select(label).distinct().limit(MAX_CLASSES + 1).collect()
        if len(found) > MAX_CLASSES:
            raise ValueError(f"{label} has more than {MAX_CLASSES} values")
        self.classes = sorted(float(r[0]) for r in found)
        number = F.lit(None).cast("int")
        for i, c in enumerate(self.classes):
            number = F.when(F.col(label) == c, i).otherwise(number)
        rows, values = labelled.withColumn("_class", number), F.unwrap_udt(features)
        size = F.max(F.coalesce(values["size"], F.size(values["values"])))
        n, self.features = rows.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
        folds = rows.agg(F.coalesce(F.max(fold), F.lit(-1))).first()[0] + 1 if fold else 0
        # Each pass is a job: more tasks than the rows are worth only cost time.
        rows = rows.coalesce(max(1, -(-n // rows_per_task)))
        self.path = stage_path(dataset.sparkSession, "blocks")
        linear.pack_rows(rows, features, "_class", fold, only).write.parquet(self.path)
        # Every pass starts all tasks anew: there are no more of them than cores.
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        self.blocks = dataset.sparkSession.read.parquet(self.path).coalesce(cores).persist()
        self.counts = linear.class_counts(self.blocks, max(1, len(self.classes)), int(folds))

    def close(self) -> None:
        self.blocks.unpersist()
        remove_stage(self.blocks.sparkSession, self.path)


class PenalisedLogisticRegression(
    Estimator, _Regularised, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter
):
    """Multinomial logistic regression minimising C * weighted loss + |w|^2 / 2."""

    #: Sums of one problem are small: several tasks share its passes.
    rows_per_task = linear.BLOCK_ROWS

    @keyword_only
    def __init__(self, *, C=1.0, classWeight="none", maxIter=1000, featuresCol="features",
                 labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, classWeight="none", maxIter=1000)
        self._set(**self._input_kwargs)

    def pairs(self, packed: Packed) -> None:
        return None

    def solve(self, packed: Packed, asked: list[tuple[dict, int | None]], near=None) -> list[Fit]:
        """Fit ``(parameters, held-out fold)`` of each request, from the coefficients ``near`` on.
        Requests that differ in the iteration limit alone share one fit."""
        limits = [g.get("maxIter", self.getMaxIter()) for g, _ in asked]
        problems = [self._problem(g, held) for g, held in asked]
        own = list(dict.fromkeys(problems))
        starts = [near] * len(own)
        fits = linear.fit_softmax(packed.blocks, own, limits, packed.counts, packed.features, starts)
        found = dict(zip(own, fits))
        return [replace(f := found[p], coefficients=f.at.get(n, f.coefficients))
                for p, n in zip(problems, limits)]

    def _fit(self, dataset: DataFrame) -> "LinearModel":
        return _fit_one(self, dataset)


class PairwiseLinearSVC(
    Estimator, _Regularised, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter
):
    """Linear support vector machines for every pair of classes, deciding by vote; ``maxIter``
    counts rounds of the dual solver."""

    @keyword_only
    def __init__(self, *, C=1.0, classWeight="none", maxIter=1000, featuresCol="features",
                 labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, classWeight="none", maxIter=1000)
        self._set(**self._input_kwargs)

    def pairs(self, packed: Packed) -> list[tuple[int, int]]:
        return list(combinations(range(len(packed.classes)), 2))

    def solve(self, packed: Packed, asked: list[tuple[dict, int | None]], near=None) -> list[Fit]:
        """Fit every pair of each request; a request's fits are joined to one. The dual solver has
        no use for coefficients ``near`` the optimum."""
        pairs = self.pairs(packed)
        problems = [self._problem(g, held, pair) for g, held in asked for pair in pairs]
        own = list(dict.fromkeys(problems))
        limit = max([g.get("maxIter", self.getMaxIter()) for g, _ in asked])
        found = dict(zip(own, linear.fit_hinge(packed.blocks, own, limit, packed.counts, packed.features)))
        out = []
        for at in range(0, len(problems), max(1, len(pairs))):
            fits = [found[p] for p in problems[at : at + len(pairs)]]
            out.append(Fit(
                np.concatenate([f.coefficients for f in fits], 1), max(f.iterations for f in fits),
                max(f.certificate for f in fits), all(f.converged for f in fits),
                bounds=tuple(b for f in fits for b in f.bounds),
            ))
        return out or [Fit(np.zeros((packed.features + 1, 0)), 0, 0.0, True) for _ in asked]

    def _fit(self, dataset: DataFrame) -> "LinearModel":
        return _fit_one(self, dataset)


def _fit_one(estimator, dataset: DataFrame) -> "LinearModel":
    packed = estimator._packed(dataset, rows_per_task=estimator.rows_per_task)
    try:
        return _model(estimator, packed, estimator.solve(packed, [({}, None)])[0])
    finally:
        packed.close()


def _model(estimator, packed: Packed, fit: Fit) -> "LinearModel":
    if not fit.converged:
        warnings.warn(f"not converged after {fit.iterations} iterations ({fit.certificate:.1e})")
    model = LinearModel(fit.coefficients, packed.classes, estimator.pairs(packed), fit)
    return model._set(
        featuresCol=estimator.getFeaturesCol(), predictionCol=estimator.getPredictionCol()
    )


class LinearModel(Model, HasFeaturesCol, HasPredictionCol):
    """A fitted classifier: the class of the greatest margin, or with ``pairs`` of the most
    votes. ``coefficients`` has a column per class or pair, and the intercepts as last row."""

    def __init__(self, coefficients=None, classes=(), pairs=None, fit: Fit | None = None):
        super().__init__()
        self.coefficients, self.classes, self.pairs = coefficients, list(classes), pairs
        self.fitted = fit

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sent = dataset.sparkSession.sparkContext.broadcast(self.coefficients)
        vectors = F.unwrap_udt(self.getFeaturesCol())
        return dataset.withColumn(
            self.getPredictionCol(), linear.decision(vectors, sent, self.classes, self.pairs)
        )


def macro_f1(cells: np.ndarray) -> float:
    """Unweighted mean F1 over the labels that occur in truth (rows) or decision (columns)."""
    sides = cells.sum(0) + cells.sum(1)
    known = sides > 0
    return float(np.mean(2.0 * np.diag(cells)[known] / sides[known])) if known.any() else 0.0


def param_maps(estimator: Estimator, grid: dict[str, list]) -> list[dict]:
    """Every combination, parameters in name order, the last varying fastest."""
    names = sorted(grid)
    return [
        {estimator.getParam(name): value for name, value in zip(names, values)}
        for values in product(*(grid[name] for name in names))
    ]


@dataclass
class Searched:
    """The refitted best model, and by candidate the mean and deviation of its fold scores."""

    bestModel: LinearModel
    avgMetrics: list[float]
    stdMetrics: list[float]
    best: int


def grid_search(
    train: DataFrame, estimator: Estimator, grid: dict[str, list], k: int = 5,
    fold_col: str = "fold", oversample: str | None = None, seed: int = 42,
) -> tuple[Searched, list[dict]]:
    """Try every combination on ``k`` given folds by macro F1 and refit the best on all
    rows; the first of equals wins. All candidates on all folds are fitted together.
    ``oversample`` names the key column to apply SMOTE inside each fold."""
    candidates = [{p.name: v for p, v in m.items()} for m in param_maps(estimator, grid)]
    rows = train
    if oversample:
        rows = _oversampled(train, estimator, k, fold_col, oversample, seed)
    packed = estimator._packed(
        rows, fold_col, "only" if oversample else None, estimator.rows_per_task
    )
    try:
        asked = [(c, f) for c in candidates for f in range(k)]
        fits = estimator.solve(packed, asked)
        models = [(f, fit.coefficients) for (_, f), fit in zip(asked, fits)]
        cells = linear.held_out_cells(
            packed.blocks, models, len(packed.classes), estimator.pairs(packed)
        )
        scores = np.array([macro_f1(c) for c in cells]).reshape(len(candidates), k)
        means = scores.mean(1)
        best = int(means.argmax())
        # The fits without one fold each lie around the fit of all rows.
        near = np.mean([fit.coefficients for fit in fits[best * k : (best + 1) * k]], 0)
        refit = estimator.solve(packed, [(candidates[best], None)], near)[0]
        model = _model(estimator, packed, refit)
    finally:
        packed.close()
    return Searched(model, means.tolist(), scores.std(1).tolist(), best), candidates


def _oversampled(train: DataFrame, estimator, k: int, fold_col: str, key: str, seed: int) -> DataFrame:
    """The rows, and for each fold and for the refit the synthetic rows that SMOTE makes from
    its training rows; ``only`` says which (-2 for the refit)."""
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    kind = train.schema[label].dataType
    wanted = [features, F.col(label).cast(kind).alias(label), fold_col, "only"]
    out = train.withColumn("only", F.lit(None).cast("int")).select(*wanted)
    for only in [*range(k), -2]:
        own = train if only == -2 else train.filter(F.col(fold_col) != only)
        made = smote(own, label, key, features, seed=seed).filter("synthetic")
        made = made.withColumn(fold_col, F.lit(None).cast("int")).withColumn("only", F.lit(only))
        out = out.unionByName(made.select(*wanted))
    return materialize(out, "oversampled", [features])


def certificates(
    train: DataFrame, estimator: Estimator, candidates: list[dict], row_id: str = "row_id"
) -> DataFrame:
    """``(candidate, n_rows, measure)``: how far each candidate's fit is from the optimum.

    The measure is computed anew from the coefficients and the rows, by joins on the features:
    the gradient's length per row weight of a softmax fit, and the duality gap of a pairwise fit
    as a share of its loss (the largest of the pairs).
    """
    spark, label = train.sparkSession, estimator.getLabelCol()
    packed = estimator._packed(train, rows_per_task=estimator.rows_per_task)
    try:
        fits = estimator.solve(packed, [(c, None) for c in candidates])
        pairs = estimator.pairs(packed)
        problems = [estimator._problem(c) for c in candidates]
        weights, _ = linear.row_weights(problems, packed.counts)
        n_rows = int(packed.counts.sum())
    finally:
        packed.close()
    sides = pairs if pairs is not None else [(i, i) for i in range(len(packed.classes))]
    # Columns of coefficients side by side, so that an entry meets all of them in one row. A softmax
    # needs all classes of a candidate at once.
    columns = [(j, k) for j in range(len(fits)) for k in range(len(sides))]
    step = WIDE if pairs is not None else max(1, WIDE // max(1, len(sides))) * len(sides)

    classes = F.array(*[F.lit(c) for c in packed.classes])
    own = (F.array_position(classes, F.col(label).cast("double")) - 1).cast("int")
    points = train.filter(F.col(label).isNotNull()).select(
        F.col(row_id).alias("row"), own.alias("y"), F.unwrap_udt(estimator.getFeaturesCol()).alias("v")
    )
    index = F.coalesce(F.col("v.indices"), F.sequence(F.lit(0), F.size("v.values") - 1))
    terms = points.select("row", F.explode(F.arrays_zip(index.alias("i"), F.col("v.values").alias("x"))).alias("t"))
    terms = terms.select("row", F.col("t.i").alias("feature"), F.col("t.x").alias("x"))
    parts = []
    for at in range(0, len(columns), max(1, step)):
        some = columns[at : at + step]
        dense = np.stack([fits[j].coefficients[:, k] for j, k in some], 1)
        w = spark.createDataFrame(
            [(i, r.tolist()) for i, r in enumerate(dense[:-1])], "feature int, w array<double>"
        )
        dots = lookup_join(terms, w, "feature", 2_000_000, "inner").groupBy("row").agg(
            *[F.sum(F.col("x") * F.get("w", F.lit(c))).alias(f"m{c}") for c in range(len(some))]
        )
        margin = [F.coalesce(f"m{c}", F.lit(0.0)) + float(dense[-1, c]) for c in range(len(some))]
        margins = points.select("row", "y").join(dots, "row", "left").select(
            "row", "y", *[m.alias(f"m{c}") for c, m in enumerate(margin)]
        )
        weight = {
            j: F.get(F.array(*[F.lit(float(x)) for x in weights[j]]), F.col("y")) for j, _ in some
        }
        if pairs is not None:
            parts += _gaps(margins, weight, [(j, *sides[k]) for j, k in some], dense, fits, some, problems)
        else:
            parts += _slopes(margins, terms, weight, some, dense, problems, len(sides))
    rows = "candidate int, measure double"
    measured = spark.createDataFrame(parts, rows).groupBy("candidate").agg(F.max("measure").alias("measure"))
    return measured.select("candidate", F.lit(n_rows).cast("bigint").alias("n_rows"), "measure")


#: Columns of coefficients whose margins are computed side by side.
WIDE = 48


def _gaps(margins, weight, columns, dense, fits, some, problems) -> list[tuple[int, float]]:
    """The duality gap of each column of pairwise coefficients, from the margins of all rows."""
    losses = []
    for c, (j, low, high) in enumerate(columns):
        side = F.when(F.col("y") == high, 1.0).otherwise(-1.0)
        loss = weight[j] * F.greatest(F.lit(0.0), 1 - side * F.col(f"m{c}"))
        losses.append(F.sum(F.when(F.col("y").isin(low, high), loss).otherwise(0.0)))
    found = margins.agg(*[F.coalesce(x, F.lit(0.0)).alias(f"l{c}") for c, x in enumerate(losses)]).first()
    out = []
    for c, (j, k) in enumerate(some):
        value = 0.5 * float(dense[:-1, c] @ dense[:-1, c]) + problems[j].C * found[c]
        out.append((j, (value - float(fits[j].bounds[k])) / max(value, 1e-300)))
    return out


def _slopes(margins, terms, weight, some, dense, problems, classes: int) -> list[tuple[int, float]]:
    """The gradient's length per row weight of each candidate among softmax columns."""
    residuals = []
    for c, (j, k) in enumerate(some):
        first = c - k
        top = F.greatest(*[F.col(f"m{first + i}") for i in range(classes)]) if classes > 1 else F.col(f"m{first}")
        total = sum((F.exp(F.col(f"m{first + i}") - top) for i in range(classes)), F.lit(0.0))
        share = F.exp(F.col(f"m{c}") - top) / total - (F.col("y") == k).cast("int")
        residuals.append((weight[j] * share).alias(f"r{c}"))
    sums = {j: weight[j].alias(f"s{j}") for j in weight}
    kept = materialize(margins.select("row", *residuals, *sums.values()), "residuals")
    names = [f"r{c}" for c in range(len(some))]
    # The gradient has as many rows as there are features, like the coefficients.
    slopes = terms.join(kept.select("row", *names), "row").groupBy("feature").agg(
        *[F.sum(F.col("x") * F.col(n)).alias(n) for n in names]
    ).collect()
    totals = kept.agg(*[F.sum(n).alias(n) for n in names], *[F.sum(f"s{j}").alias(f"s{j}") for j in weight]).first()
    gradient = np.zeros(dense.shape)
    for r in slopes:
        gradient[r.feature] = r[1:]
    gradient[:-1] += dense[:-1] / np.array([problems[j].C for j, _ in some])
    gradient[-1] = totals[: len(names)]
    return [
        (j, float(np.linalg.norm(gradient[:, [c for c, (i, _) in enumerate(some) if i == j]])) / totals[f"s{j}"])
        for j in weight
    ]


def cv_results(
    spark: SparkSession, fitted: Searched, candidates: list[dict], top: int | None = 10
) -> DataFrame:
    """``(candidate, rank_test_score, mean_test_score, std_test_score, param_*)``.

    One row per candidate: as many as the grid has, so they come from the driver.
    """
    names = sorted({name for c in candidates for name in c})
    rows = [
        (i, float(m), float(s), *[str(c.get(name)) for name in names])
        for i, (c, m, s) in enumerate(zip(candidates, fitted.avgMetrics, fitted.stdMetrics))
    ]
    columns = "candidate int, mean_test_score double, std_test_score double" + "".join(
        f", param_{name} string" for name in names
    )
    return rank_candidates(spark.createDataFrame(rows, columns), top)


def rank_candidates(scores: DataFrame, top: int | None = 10) -> DataFrame:
    """Rank by mean score, equal scores sharing the best rank; the ``top`` first.

    A rank is one more than the rows with a higher score, so the first rows need no others;
    without ``top`` only the counts of the distinct scores are added up in one place.
    """
    best = Window.orderBy(F.desc("mean_test_score"))
    if top:
        first = scores.orderBy(F.desc("mean_test_score"), "candidate").limit(top)
        ranked = first.withColumn("rank_test_score", F.rank().over(best))
    else:
        above = F.sum("n").over(best.rowsBetween(Window.unboundedPreceding, -1))
        ranks = scores.groupBy("mean_test_score").agg(F.count(F.lit(1)).alias("n")).select(
            "mean_test_score", (F.coalesce(above, F.lit(0)) + 1).cast("int").alias("rank_test_score")
        )
        ranked = scores.join(ranks, "mean_test_score")
    return ranked.orderBy("rank_test_score", "candidate")


def predict(df: DataFrame, model: Model, row_id: str = "row_id", label: str = "label") -> DataFrame:
    """``(row_id, y_true, y_pred)`` with class names."""
    return model.transform(df).select(
        row_id,
        class_name(F.col(label)).alias("y_true"),
        class_name(F.col("prediction")).alias("y_pred"),
    )


def evaluate_models(
    df: DataFrame, models: dict[str, DataFrame | None], row_id: str = "row_id",
    label: str = "sentiment",
) -> tuple[DataFrame, DataFrame]:
    """Metrics per model and confusion matrices on one test table.

    ``models`` maps a name to its ``(row_id, y_pred)`` table. A row a model has no prediction
    for counts as wrong, and ``unmatched`` says how many these are. A model given as ``None``
    was not available: its metrics row carries an error and it has no confusion matrix.
    """
    spark = df.sparkSession
    ready = {name: table for name, table in models.items() if table is not None}
    tables = [
        df.select(row_id, F.col(label).alias("y_true"))
        .join(table.select(row_id, "y_pred"), row_id, "left")
        .withColumn("model", F.lit(name))
        for name, table in ready.items()
    ]
    both = tables[0]
    for table in tables[1:]:
        both = both.unionByName(table)
    gaps = both.groupBy("model").agg(
        F.count_if(F.col("y_pred").isNull()).alias("unmatched"),
    )
    metrics = classification_metrics(both, by=["model"]).join(F.broadcast(gaps), "model")
    metrics = metrics.withColumn("error", F.lit(None).cast("string"))
    absent = [(name, "model not found") for name, table in models.items() if table is None]
    if absent:
        missing = spark.createDataFrame(absent, "model string, error string")
        metrics = metrics.unionByName(missing, allowMissingColumns=True)
    return metrics, confusion_matrix(both, by=["model"])


# --- storage -------------------------------------------------------------------------------


def save_model(model: LinearModel, path: str) -> None:
    """Save a fitted classifier: a row of coefficients for each class or pair."""
    spark = SparkSession.getActiveSession()
    named = model.pairs if model.pairs is not None else [(i, None) for i in range(len(model.classes))]
    rows = [
        (i, low, high, model.classes, [float(x) for x in column])
        for i, ((low, high), column) in enumerate(zip(named, model.coefficients.T))
    ]
    columns = "row int, low int, high int, classes array<double>, coefficients array<double>"
    spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> LinearModel:
    """Read a saved classifier; as many rows as it has classes or pairs."""
    rows = spark.read.parquet(path).orderBy("row").collect()
    pairs = [(r.low, r.high) for r in rows] if rows and rows[0].high is not None else None
    return LinearModel(np.array([r.coefficients for r in rows]).T, rows[0].classes, pairs)
