"""The three ways through the library: lexicon evaluation, supervised models,
ratings and generation. Wide intermediate results are Parquet stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.operators import classify, evaluate, sampling, tfidf
from reviewlab.operators.generate import Factory, reply_to_questions, step_status, template_reply
from reviewlab.operators.lexicon import attach_predictions, lexicon_compound, lexicon_polarity
from reviewlab.operators.profile import profile_report, subset_report
from reviewlab.operators.ratings import adjust_ratings, rating_adjustment_summary
from reviewlab.operators.smote import smote
from reviewlab.operators.summarize import summarize_long
from reviewlab.plans.prepare import RunCounts, prepare_reviews
from reviewlab.sources.stages import (
    materialize,
    read_stage,
    stored,
    write_summary,
    write_table,
    write_text,
)

LEXICON_MODELS = ["compound_pred", "polarity_pred"]
# The columns kept beside the features.
FEATURE_LABELS = ["review_id", "sentiment", "overall", "asin", "reviewerID", "unixReviewTime"]


def lexicon_evaluation(
    raw: DataFrame, lexicon: DataFrame, out_dir: str, n: int = 1000, seed: int = 42,
    modifiers: DataFrame | None = None,
) -> DataFrame:
    """Label, clean, sample, score with both lexicon models, evaluate, write. Returns the
    metrics table. The raw rows are parsed once; the draw reads the stored ones."""
    drawn = ["review_id", "text", "sentiment", "overall"]
    with stored(prepare_reviews(raw).select(drawn), "prepared") as prepared:
        sample = sampling.quota_sample(prepared, n, "review_id", seed=seed).select(drawn)
        with stored(sample, "sample") as sample:
            scored = attach_predictions(
                sample,
                {
                    "compound_pred": lexicon_compound(
                        sample, lexicon, "review_id", modifiers=modifiers
                    ),
                    "polarity_pred": lexicon_polarity(
                        sample, lexicon, "review_id", modifiers=modifiers
                    ),
                },
                "review_id",
            )
            write_table(scored, f"{out_dir}/sample")
    scored = read_stage(raw.sparkSession, f"{out_dir}/sample")
    metrics = evaluate.compare_models(scored, LEXICON_MODELS, "review_id", "sentiment")
    write_table(metrics, f"{out_dir}/comparison", "csv")
    for model in LEXICON_MODELS:
        matrix = evaluate.confusion_matrix(scored, "sentiment", model)
        write_table(matrix, f"{out_dir}/confusion_{model}", "csv")
    return metrics


def subset_and_profile(raw: DataFrame, out_dir: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """Labelled subset, its profile, and a report of the rows each step left. Returns the subset
    stage table. The raw rows are parsed and counted once, while the prepared ones are stored."""
    counts = RunCounts()
    with stored(prepare_reviews(raw, counts=counts), "prepared") as prepared:
        subset = sampling.stratified_subset(prepared, n, "review_id", seed=seed)
        write_table(subset, f"{out_dir}/subset")
    stage = read_stage(raw.sparkSession, f"{out_dir}/subset")
    write_table(subset_report(stage, counts.get()), f"{out_dir}/subset_report", "csv")
    write_summary(profile_report(stage), f"{out_dir}/profile")
    return stage


def build_features(
    subset: DataFrame, out_dir: str, min_df: int | float = 2, max_df: int | float = 0.95,
    max_features: int = 20_000, ngram: tuple[int, int] = (1, 2), fit_on: DataFrame | None = None,
) -> DataFrame:
    """TF-IDF features and vocabulary of the subset, as stage tables.

    ``fit_on`` restricts the vocabulary to those rows, such as the training rows.
    """
    spark = subset.sparkSession
    prepared = tfidf.prepare_text(subset)
    fitted = prepared
    if fit_on is not None:
        fitted = prepared.join(fit_on.select("review_id"), "review_id", "left_semi")
    vocabulary = tfidf.fit_vocabulary(
        tfidf.row_terms(fitted, "review_id", ngram=ngram), min_df, max_df, max_features
    )
    write_table(vocabulary, f"{out_dir}/vocabulary")
    vocabulary = read_stage(spark, f"{out_dir}/vocabulary")
    terms = tfidf.row_terms(prepared, "review_id", ngram=ngram)
    rows = tfidf.tfidf_rows(terms, vocabulary, "review_id")
    vectors = tfidf.tfidf_vectors(rows, vocabulary.count(), "review_id")
    labels = prepared.select(
        *[c for c in FEATURE_LABELS if c in prepared.columns]
    )
    write_table(vectors.join(labels, "review_id"), f"{out_dir}/features")
    summary = tfidf.tfidf_summary(
        subset, prepared, vocabulary, "sentiment", min_df, max_df, max_features, ngram
    )
    write_summary(summary, f"{out_dir}/features_summary")
    return read_stage(spark, f"{out_dir}/features")


def train_classifier(
    features: DataFrame, out_dir: str, kind: str = "logreg", split: str = "group", k: int = 5,
    seed: int = 42, use_smote: bool = True, grid: dict[str, list] | None = None,
):
    """Split, balance, tune, refit, predict the hold-out, write, with a summary of the sizes, the
    best parameters and their score. Returns the best model.

    ``split`` is ``group`` (products stay together) or ``row``. Class counts are reported
    before and after oversampling, and the key overlap of the split is computed.
    """
    spark = features.sparkSession
    if split == "group":
        parted = sampling.group_stratified_split(features, "asin", seed=seed)
    else:
        parted = sampling.stratified_split(features, "review_id", seed=seed)
    parted = materialize(classify.with_class_index(parted), "split")
    train, test = parted.filter("split = 'train'"), parted.filter("split = 'test'")

    keys = [c for c in ["review_id", "asin", "reviewerID"] if c in parted.columns]
    leakage = sampling.leakage_report(train, test, keys)
    sampling.warn_on_leakage(leakage.filter("key_name <> 'asin'"))
    write_table(leakage, f"{out_dir}/leakage")
    write_table(
        classify.class_weights(train).withColumn("stage", F.lit("before")),
        f"{out_dir}/train_classes_before",
    )

    train = train.select(F.col("review_id").cast("string").alias("row_id"), "features", "sentiment")
    if use_smote:
        train = smote(train, "sentiment", "row_id", seed=seed).select(
            "row_id", "features", "sentiment"
        )
    train = sampling.stratified_folds(train, k, "row_id", seed=seed)
    train = materialize(classify.with_class_index(train), "train").persist()
    write_table(
        classify.class_weights(train).withColumn("stage", F.lit("after")),
        f"{out_dir}/train_classes_after",
    )

    if kind == "logreg":
        estimator, grid = classify.PenalisedLogisticRegression(), grid or classify.LOGREG_GRID
    else:
        estimator, grid = classify.PairwiseLinearSVC(), grid or classify.SVM_GRID
    fitted, candidates = classify.grid_search(train, estimator, grid, k)
    train.unpersist()
    model = fitted.bestModel
    classify.save_model(model, f"{out_dir}/model")
    write_table(classify.cv_results(spark, fitted, candidates), f"{out_dir}/cv_results", "csv")

    predictions = classify.predict(test, model, "review_id")
    write_table(predictions, f"{out_dir}/test_predictions")
    predictions = read_stage(spark, f"{out_dir}/test_predictions")
    write_summary(evaluate.classification_metrics(predictions), f"{out_dir}/metrics")
    write_table(evaluate.confusion_matrix(predictions), f"{out_dir}/confusion", "csv")

    best = candidates[fitted.best]
    sizes = parted.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    report = sizes.select(
        "*",
        F.lit(split).alias("split_method"),
        F.lit(seed).alias("seed"),
        F.lit(k).alias("cv_folds"),
        F.lit(use_smote).alias("smote_applied"),
        F.create_map(*[F.lit(str(x)) for item in sorted(best.items()) for x in item]).alias("best_params"),
        F.lit(round(fitted.avgMetrics[fitted.best], 4)).alias("best_cv_f1_macro"),
        F.lit(model.fitted.converged).alias("converged"),
    )
    write_summary(report, f"{out_dir}/training_summary")
    return model


def compare_on_sample(
    sample: DataFrame, vocabulary: DataFrame, models: dict, out_dir: str,
    ngram: tuple[int, int] = (1, 2),
) -> DataFrame:
    """All models on one test table: the lexicon labels it carries, and trained models by
    name (``None`` where missing). Scoring normalises the text as training did."""
    prepared = tfidf.prepare_text(sample, label=None)
    terms = tfidf.row_terms(prepared, "review_id", ngram=ngram)
    rows = tfidf.tfidf_rows(terms, vocabulary, "review_id")
    # Rows whose text normalises to nothing are scored as well: as an empty vector.
    missing = sample.join(prepared.select("review_id"), "review_id", "left_anti").select(
        "review_id", F.array().cast(rows.schema["entries"].dataType).alias("entries")
    )
    vectors = tfidf.tfidf_vectors(rows.unionByName(missing), vocabulary.count(), "review_id")
    test = materialize(
        classify.with_class_index(vectors.join(sample, "review_id")), "test"
    )
    for name in LEXICON_MODELS:
        if name not in test.columns:
            test = attach_predictions(test, {name: None})
    tables = {
        name: test.select("review_id", F.col(name).alias("y_pred")) for name in LEXICON_MODELS
    }
    for name, model in models.items():
        tables[name] = classify.predict(test, model, "review_id") if model is not None else None
    metrics, confusions = classify.evaluate_models(test, tables, "review_id")
    write_table(metrics, f"{out_dir}/comparison", "csv")
    write_table(confusions, f"{out_dir}/confusions", "csv")
    write_table(evaluate.set_sizes(test, "sentiment"), f"{out_dir}/test_set", "csv")
    return metrics


def ratings_and_replies(
    subset: DataFrame, out_dir: str, vocabulary: DataFrame | None = None,
    replier: Factory | None = template_reply, n_summaries: int | None = 10,
    n_replies: int | None = 1,
) -> DataFrame:
    """Adjusted ratings, summaries of long reviews and replies to questions. A part that
    fails or is left out becomes a row of the returned status table."""
    spark: SparkSession = subset.sparkSession

    def ratings() -> None:
        adjusted = adjust_ratings(subset)
        write_table(adjusted, f"{out_dir}/adjusted_ratings")
        write_summary(
            rating_adjustment_summary(read_stage(spark, f"{out_dir}/adjusted_ratings")),
            f"{out_dir}/adjusted_ratings_summary",
        )

    def summaries() -> None:
        write_table(summarize_long(subset, vocabulary, n_summaries), f"{out_dir}/summaries")

    def replies() -> None:
        answered = reply_to_questions(subset, replier, n=n_replies)
        write_table(answered, f"{out_dir}/replies")
        write_text(
            read_stage(spark, f"{out_dir}/replies"),
            f"{out_dir}/replies_text",
            ["original_text", "response"],
            ["Selected Customer Review", "Generated Customer Service Response"],
        )

    status = step_status(
        spark,
        {
            "ratings": ratings,
            "summaries": summaries if vocabulary is not None else None,
            "replies": replies if replier is not None else None,
        },
    )
    write_table(status, f"{out_dir}/status")
    return status
