"""The corpus pipeline: quality, shared lines, near copies, benchmark passages, encoding.

``STAGES`` lists its steps; each takes what its predecessor kept. ``run`` writes every step's
rows as Parquet in the shared scratch folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.llm import bpe, decontaminate, line_dedup, near_dedup, quality_model
from reviewlab.llm.common import table
from reviewlab.llm.queries import WORD_VOCABULARY, vocabulary_path
from reviewlab.session import configure
from reviewlab.sources.stages import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier, fitted on the labelled ones among them, does not reject."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs.select(*COLUMNS), model)
    return scored.filter("score >= 0.5").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share; ``n_chars`` follows the text.

    Copies of one document are no boilerplate: they are left to the next stage, which keeps one.
    """
    cleaned = line_dedup.drop_shared_lines(
        docs.select(*COLUMNS),
        min_texts=line_dedup.MIN_SITES,
        copy_percent=line_dedup.COPY_PERCENT,
    )
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars.cast("bigint")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_first(docs.select(*COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark's items."""
    items = table(spark, sf_dir, "benchmark")
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), items)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of the ids and of the text decoded from them."""
    coded = bpe.round_trip(docs, vocabulary_path(WORD_VOCABULARY))
    return coded.select(
        "doc_id",
        "ids",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("encoding", encoding),
]

#: Neither the classifier nor the encoding is something SQL can state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
