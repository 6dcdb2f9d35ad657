"""Extractive summaries: the default summariser, without a model.

A sentence scores the mean TF-IDF weight of its words. The best sentences are kept
while they fit the word budget and returned in reading order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from reviewlab.functions.terms import tokens
from reviewlab.functions.text import normalize_tokens, spaced, squeeze, word_count
from reviewlab.operators.generate import _first_or_all, long_texts
from reviewlab.operators.joins import lookup_join
from reviewlab.operators.tfidf import BROADCAST_TERMS
from reviewlab.sources.stages import materialize

#: Texts of one task.
TEXTS_PER_TASK = 1_000
#: Enough for any sum order to round alike when sentences tie.
SCORE_DIGITS = 6


def sentences(text: Column | str) -> Column:
    """Sentences of a text: cut after ., ! or ? followed by whitespace."""
    parts = F.split(spaced(text), "(?<=[.!?]) +")
    return F.filter(F.transform(parts, lambda s: squeeze(s)), lambda s: s != "")


def summarize_long(
    df: DataFrame, vocabulary: DataFrame, n: int | None = 10, min_words: int = 100,
    target_words: int = 50, row_id: str = "review_id", text: str = "text",
) -> DataFrame:
    """``(review_id, original_text, word_count, generated_summary)`` for the first ``n`` long
    texts, or all of them with ``n=None``.

    ``vocabulary`` has ``(term, idf)`` of single words. The best sentence always stays;
    further ones, best first, are kept while the running word count fits.
    """
    chosen = _first_or_all(long_texts(df, min_words, row_id, text), n, "long texts")
    vocab = materialize(vocabulary.select("term", "idf"), "vocabulary")
    # One shuffle by text id; every group below is inside one text, so the planner
    # reuses this partitioning throughout. The words of a text take many times its room: the
    # number of parts follows the rows and is stated, so that parts are not merged by bytes.
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.count() if n is None else n
    parts = max(least, -(-rows // TEXTS_PER_TASK))
    split = (
        chosen.select("review_id", "original_text")
        .repartition(parts, "review_id")
        .select("review_id", F.posexplode_outer(sentences("original_text")).alias("pos", "sentence"))
        .filter("sentence is not null")
        .withColumn("n_words", word_count("sentence"))
    )
    counted = (
        split.select(
            "review_id",
            "pos",
            F.explode_outer(tokens(normalize_tokens("sentence"))).alias("term"),
        )
        .filter("term is not null")
        .groupBy("review_id", "pos", "term")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("tf", F.sum("times").over(Window.partitionBy("review_id", "term")))
    )
    used = lookup_join(counted, vocab, "term", BROADCAST_TERMS)
    weight = F.coalesce((1.0 + F.log("tf")) * F.col("idf"), F.lit(0.0))
    scores = used.groupBy("review_id", "pos").agg(
        F.round(F.sum(F.col("times") * weight) / F.sum("times"), SCORE_DIGITS).alias("score")
    )
    best = Window.partitionBy("review_id").orderBy(F.desc("score"), "pos")
    ranked = (
        split.join(scores, ["review_id", "pos"], "left")
        .na.fill(0.0, ["score"])
        .withColumn("rank", F.row_number().over(best))
        .withColumn(
            "budget", F.sum("n_words").over(best.rowsBetween(Window.unboundedPreceding, 0))
        )
        .filter((F.col("rank") == 1) | (F.col("budget") <= target_words))
    )
    kept = ranked.groupBy("review_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "sentence"))).alias("kept")
    )
    return chosen.join(kept, "review_id", "left").select(
        "review_id",
        "original_text",
        "word_count",
        F.coalesce(F.array_join(F.col("kept.sentence"), " "), F.lit("")).alias(
            "generated_summary"
        ),
    )
