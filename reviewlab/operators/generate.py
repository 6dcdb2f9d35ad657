"""Batch text generation with a generator the caller supplies.

A generator factory takes no arguments and returns a function from prompt to text;
it is called once per partition, so a model is loaded once per task. This is the
only place rows meet a Python worker, and they arrive as Arrow batches.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reviewlab.functions.prompts import (
    REPLY_PROMPT,
    SUMMARY_PROMPT,
    build_prompt,
    clean_generated,
    strip_echo,
)
from reviewlab.functions.text import is_question, preview, word_count
from reviewlab.operators.sampling import first_n
from reviewlab.schema import require_columns

# Workers need not have this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows whose texts a task holds in Python at a time.
PART_ROWS = 256

Generator = Callable[[str], str]
Factory = Callable[[], Generator]


class TaskUnavailable(Exception):
    """Raised by a factory whose kind of task the environment does not offer."""


def _load(primary: Factory, fallback: Factory | None) -> tuple[Generator, str]:
    try:
        return primary(), "primary"
    except TaskUnavailable:
        if fallback is None:
            raise
        return fallback(), "fallback"


def generate(
    df: DataFrame, prompt: str, primary: Factory, fallback: Factory | None = None,
    keep_going: bool = True,
) -> DataFrame:
    """Add ``generated``, ``generator_used`` and ``error``.

    One call per row. The fallback runs when the primary task is unavailable; any other
    loading error fails the job. A failing row gives empty text and its error, or fails
    the job when ``keep_going`` is false.
    """
    require_columns(df, [prompt])
    schema = T.StructType(
        df.schema.fields
        + [
            T.StructField("generated", T.StringType()),
            T.StructField("generator_used", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )

    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generator = used = None
        for batch in batches:
            if generator is None:
                generator, used = _load(primary, fallback)
            # A few rows at a time: long texts take much more room as Python's texts.
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                texts, errors = [], []
                for p in part.column(prompt).to_pylist():
                    try:
                        texts.append(str(generator(p)).strip())
                        errors.append(None)
                    except Exception as exc:
                        if not keep_going:
                            raise
                        texts.append("")
                        errors.append(f"{type(exc).__name__}: {exc}")
                made = [pa.array(x, pa.string()) for x in (texts, [used] * len(texts), errors)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)

    return df.mapInArrow(run, schema)


def long_texts(
    df: DataFrame, min_words: int = 100, row_id: str = "review_id", text: str = "text"
) -> DataFrame:
    """``(review_id, original_text, word_count)`` of texts with more than ``min_words``
    words, by the stored ``word_len`` where there is one."""
    require_columns(df, [text, row_id])
    if "word_len" in df.columns:
        words = F.coalesce(F.col("word_len").try_cast("int"), F.lit(0))
    else:
        words = word_count(text)
    return df.select(
        F.col(row_id).alias("review_id"),
        F.col(text).alias("original_text"),
        words.alias("word_count"),
    ).filter(F.col("word_count") > min_words)


def detect_questions(df: DataFrame, row_id: str = "review_id", text: str = "text") -> DataFrame:
    """``(review_id, original_text, word_count)`` of the question-like texts."""
    require_columns(df, [text, row_id])
    return df.filter(is_question(text)).select(
        F.col(row_id).alias("review_id"),
        F.col(text).alias("original_text"),
        word_count(text).alias("word_count"),
    )


def _first_or_all(df: DataFrame, n: int | None, what: str) -> DataFrame:
    if n is None:
        return df
    chosen = first_n(df, n, "review_id")
    found = chosen.count()
    if found == 0:
        raise ValueError(f"no {what} found")
    if found < n:
        warnings.warn(f"only {found} {what} found; taking all of them instead of {n}")
    return chosen


def generate_summaries(
    df: DataFrame, primary: Factory, fallback: Factory | None = None, n: int | None = 10,
    min_words: int = 100, row_id: str = "review_id",
) -> DataFrame:
    """``(review_id, original_text, word_count, generated_summary, generator_used, error)``
    for the first ``n`` long texts, or all; a failed one has an empty summary.

    The primary generator receives the text itself, the fallback the summary prompt, and
    the echo of the prompt is removed from what the fallback returns.
    """
    chosen = _first_or_all(long_texts(df, min_words, row_id), n, "long texts")
    # Only the text travels to the workers; the fallback builds its prompt from it.
    before, after = SUMMARY_PROMPT.split("{text}")

    def prompting() -> Generator:
        inner = fallback()
        return lambda text: inner(before + text + after)

    out = generate(
        chosen, "original_text", primary, prompting if fallback is not None else None
    )
    prompt = build_prompt("original_text", SUMMARY_PROMPT)
    completion = clean_generated(strip_echo("generated", prompt))
    return out.select(
        "review_id",
        "original_text",
        "word_count",
        F.when(F.col("generator_used") == "fallback", completion)
        .otherwise(F.col("generated"))
        .alias("generated_summary"),
        "generator_used",
        "error",
    )


def reply_to_questions(
    df: DataFrame, primary: Factory, fallback: Factory | None = None, n: int | None = None,
    row_id: str = "review_id",
) -> DataFrame:
    """``(review_id, original_text, word_count, response, generator_used, review_preview,
    response_preview)`` for all question-like texts, or the first ``n``. A failing reply
    fails the job."""
    chosen = _first_or_all(detect_questions(df, row_id), n, "questions")
    prompted = chosen.withColumn("prompt", build_prompt("original_text", REPLY_PROMPT))
    out = generate(prompted, "prompt", primary, fallback, keep_going=False)
    completion = clean_generated(strip_echo("generated", "prompt"))
    response = F.when(F.col("generator_used") == "fallback", completion).otherwise(
        F.col("generated")
    )
    return out.select(
        "review_id",
        "original_text",
        "word_count",
        response.alias("response"),
        "generator_used",
        preview("original_text").alias("review_preview"),
        preview(response).alias("response_preview"),
    )


def template_reply() -> Generator:
    """Default generator for replies: a fixed courteous answer."""
    return lambda prompt: (
        "Thank you for your message. Our team will look into your question and "
        "get back to you with the details."
    )


def step_status(spark: SparkSession, steps: dict[str, Callable[[], object] | None]) -> DataFrame:
    """Run the steps in order; ``(step, status, message)`` per step: ``ok``, ``error`` with
    its message, or ``skipped`` for ``None``. A failing step does not stop the next."""
    rows = []
    for name, step in steps.items():
        if step is None:
            rows.append((name, "skipped", None))
            continue
        try:
            step()
            rows.append((name, "ok", None))
        except Exception as exc:
            rows.append((name, "error", str(exc)))
    return spark.createDataFrame(rows, "step string, status string, message string")
