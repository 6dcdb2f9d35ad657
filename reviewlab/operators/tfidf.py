"""TF-IDF over word n-grams.

Counting inside a row is array work and moves nothing. Two shuffles remain: terms
with their document and corpus counts (combined map-side, so frequent words are as
cheap as rare ones) and one row-keyed regrouping of the vocabulary terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from reviewlab.functions.terms import count_terms, let, ngrams, tokens
from reviewlab.functions.text import has_tokens, normalize_tokens
from reviewlab.operators.joins import lookup_join
from reviewlab.operators.rowids import with_row_id
from reviewlab.schema import LABELS, require_columns
from reviewlab.sources.stages import materialize

#: Largest vocabulary that is sent to every executor (about 100 bytes a term).
BROADCAST_TERMS = 1_000_000


def prepare_text(
    df: DataFrame, text: str = "text", label: str | None = "sentiment", out: str = "text_norm"
) -> DataFrame:
    """Normalise the text, drop rows without any and rows outside the label domain."""
    require_columns(df, [text] + ([label] if label else []))
    # The test is on the raw text: one on the new column would compute it twice.
    rows = df.filter(has_tokens(text)).withColumn(out, normalize_tokens(text))
    return rows.filter(F.col(label).isin(LABELS)) if label else rows


def filter_domain(df: DataFrame, col: str, domain: list[str] = LABELS) -> DataFrame:
    return df.filter(F.col(col).isin(domain))


def row_terms(
    df: DataFrame, row_id: str = "row_id", text: str = "text_norm", ngram: tuple[int, int] = (1, 2)
) -> DataFrame:
    """``(row_id, terms array<struct<term, tf>>)`` from normalised text. Row-local."""
    return df.select(row_id, count_terms(ngrams(tokens(text), *ngram)).alias("terms"))


def tokenize_ngrams(
    df: DataFrame, row_id: str = "row_id", text: str = "text_norm", ngram: tuple[int, int] = (1, 2)
) -> DataFrame:
    """``(row_id, term, tf)``, one row per distinct term of a row."""
    return _unnest(row_terms(df, row_id, text, ngram), row_id)


def _unnest(terms: DataFrame, *keep: str) -> DataFrame:
    """One row per term. The outer form keeps the planner from adding a non-empty test
    that would count every row's terms a second time."""
    return terms.select(*keep, F.inline_outer("terms")).filter("term is not null")


def _bound(limit: int | float) -> Column:
    """A document-count bound: a fraction of the documents, or a number of them."""
    return F.col("n_docs") * limit if isinstance(limit, float) else F.lit(limit)


def fit_vocabulary(
    terms: DataFrame, min_df: int | float = 2, max_df: int | float = 0.95,
    max_features: int | None = 20_000,
) -> DataFrame:
    """``(term, term_id, df, cf, idf)`` from the output of ``row_terms``.

    Keeps terms within the document-frequency bounds; of those the ``max_features``
    with the highest corpus frequency, equal ones in term order, or all with ``None``; ids
    are alphabetical. ``idf = ln((1 + N) / (1 + df)) + 1``.
    """
    if max_features is not None and max_features < 1:
        raise ValueError("max_features must be positive")
    n_docs = terms.agg(F.count(F.lit(1)).alias("n_docs"))
    counted = (
        _unnest(terms)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
        .crossJoin(F.broadcast(n_docs))
        .filter((F.col("df") >= _bound(min_df)) & (F.col("df") <= _bound(max_df)))
    )
    if max_features is None:
        numbered = with_row_id(counted, ["term"], "term_id")
    else:
        # At most max_features rows are numbered here.
        kept = counted.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
        numbered = kept.withColumn("term_id", F.row_number().over(Window.orderBy("term")) - 1)
    return numbered.select(
        "term",
        F.col("term_id").cast("int"),
        "df",
        "cf",
        (F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"),
    )


def tfidf_rows(
    terms: DataFrame, vocabulary: DataFrame, row_id: str = "row_id", words: bool = True
) -> DataFrame:
    """``(row_id, entries array<struct<term_id, term, weight>>)``, entries in id order;
    without ``words`` they have no ``term``, which is most of what is shuffled.

    Weight ``(1 + ln tf) * idf``, scaled so a row has unit length. Terms outside the
    vocabulary are dropped; a row left without terms stays, with no entries.
    """
    # Written once: its size decides how it is joined, whatever it was limited to.
    vocab = materialize(vocabulary.select("term", "term_id", "idf"), "vocabulary")
    counted = terms.select(row_id, F.inline_outer("terms"))
    names = ["term_id", "term"] if words else ["term_id"]
    weighted = lookup_join(counted, vocab, "term", BROADCAST_TERMS).select(
        row_id,
        F.when(
            F.col("term_id").isNotNull(),
            F.struct(*names, ((1.0 + F.log("tf")) * F.col("idf")).alias("raw")),
        ).alias("entry"),
    )
    # A row's terms sit next to each other, so one array per row is what is shuffled.
    grouped = weighted.groupBy(row_id).agg(F.sort_array(F.collect_list("entry")).alias("raw"))

    # Bound once: inside the element function the length would be computed per element.
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda a, e: a + e["raw"] * e["raw"]))
    entries = let(
        norm,
        lambda length: F.transform(
            "raw",
            lambda e: F.struct(
                *[e[name].alias(name) for name in names],
                (e["raw"] / length).alias("weight"),
            ),
        ),
    )
    return grouped.select(row_id, entries.alias("entries"))


def tfidf_long(rows: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``(row_id, term_id, term, weight)``."""
    return rows.select(row_id, F.inline_outer("entries")).filter("term is not null")


def vector_struct(indices: Column, values: Column, size: int | Column) -> Column:
    """A sparse vector as the struct vectors are stored in."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        (F.lit(size) if isinstance(size, int) else size).cast("int").alias("size"),
        indices.alias("indices"),
        values.alias("values"),
    )


def tfidf_vectors(rows: DataFrame, size: int, row_id: str = "row_id") -> DataFrame:
    """``(row_id, features)`` as sparse vectors of length ``size``, written once: vectors are
    stored as structs, and read back as vectors."""
    entries = F.col("entries")
    stored = vector_struct(entries["term_id"], entries["weight"], size)
    return materialize(rows.select(row_id, stored.alias("features")), "features", ["features"])


def join_labels(features: DataFrame, labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Match features to labels by key; running the plan raises when either side has a row the
    other lacks."""
    both = features.withColumn("_f", F.lit(True)).join(
        labels.withColumn("_l", F.lit(True)), row_id, "full"
    )
    lone = F.concat(
        F.lit("no match for row "),
        F.coalesce(F.col(row_id).cast("string"), F.lit("null")),
        F.when(F.col("_l").isNull(), ": features only").otherwise(": label only"),
    )
    matched = F.when(F.col("_f") & F.col("_l"), F.lit(True)).otherwise(
        F.raise_error(lone).cast("boolean")
    )
    return both.filter(matched).drop("_f", "_l")


def vocabulary_table(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.select(F.col("term").alias("feature"))


def tfidf_summary(
    source: DataFrame, prepared: DataFrame, vocabulary: DataFrame, label: str = "sentiment",
    min_df: int | float = 2, max_df: int | float = 0.95, max_features: int = 20_000,
    ngram: tuple[int, int] = (1, 2),
) -> DataFrame:
    """One row: rows in and kept, vocabulary size, label counts and the configuration."""
    rows_in = source.agg(F.count(F.lit(1)).alias("rows_input"))
    kept = prepared.agg(
        F.count(F.lit(1)).alias("rows_kept"),
        *[F.count_if(F.col(label) == name).alias(f"n_{name.lower()}") for name in LABELS],
    )
    size = vocabulary.agg(F.count(F.lit(1)).alias("vocabulary_size"))
    config = F.struct(
        F.lit(max_features).alias("max_features"),
        F.lit(min_df).alias("min_df"),
        F.lit(max_df).alias("max_df"),
        F.array(F.lit(ngram[0]), F.lit(ngram[1])).alias("ngram_range"),
        F.lit(True).alias("sublinear_tf"),
    )
    # Three single rows.
    return (
        rows_in.crossJoin(F.broadcast(kept))
        .crossJoin(F.broadcast(size))
        .withColumn("tfidf_config", config)
    )
