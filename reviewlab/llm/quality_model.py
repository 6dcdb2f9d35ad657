"""Quality classifier: gradient-boosted trees over document statistics.

Statistics are taken from every whole text where it is stored. The trees are fitted on a
bounded, seeded sample of the labelled rows (``FIT_ROWS``), by histograms of binned
statistics, and flattened into arrays, so that scoring a batch is a few array operations
per level of all trees at once.

Edge cases: a null text counts as empty and is scored like any other; repeated rows are each
scored; labels that are null are ignored and repeated labels of an id averaged; without
labels, or with labels of one kind, the score is their share (0.5 without any); other
columns are kept, those named like an output are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlab.functions.hashing import uniform
from reviewlab.llm.common import fields, map_rows, short_batches
from reviewlab.llm.quality_rules import known_words

#: Labelled rows a fit uses, about: a seeded share of the rows is drawn when there are more.
FIT_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, PENALTY, MIN_CURVATURE = 0.15, 1.0, 4.0

STATISTICS = (
    "chars words word_length symbols upper digits marks brackets shouts spaces wide "
    "lines line_length repeated_lines distinct_words distinct_windows function_words packed"
).split()
FUNCTION_WORDS = frozenset(known_words())
SYMBOLS, UPPER, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))


def _share(raw: bytes, kind: bytes) -> float:
    return (len(raw) - len(raw.translate(None, kind))) / len(raw)


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "replace")
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    windows = set(zip(words, words[1:], words[2:]))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        _share(raw, SYMBOLS),
        _share(raw, UPPER),
        _share(raw, DIGITS),
        _share(raw, b".,;:?"),
        _share(raw, b"'\"()[]{}-_/\\"),
        _share(raw, b"!"),
        _share(raw, b" \t\r\n"),
        1 - len(text) / len(raw),
        np.log1p(len(lines)),
        len(text) / len(lines),
        1 - len(set(lines)) / len(lines),
        len(set(words)) / n,
        len(windows) / max(1, len(words) - 2),
        sum(map(FUNCTION_WORDS.__contains__, map(str.lower, words))) / n,
        len(zlib.compress(raw, 1)) / len(raw),
    ]


class Trees(NamedTuple):
    """Complete trees side by side: inner nodes level by level, then leaves."""

    base: float
    feature: np.ndarray  # trees × (2^depth - 1)
    threshold: np.ndarray  # trees × (2^depth - 1)
    leaf: np.ndarray  # trees × 2^depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        margin = np.full(len(x), self.base)
        if len(self.leaf):
            rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
            inner = self.feature.shape[1]
            node = np.zeros((len(x), len(self.leaf)), np.int64)
            while node.size and node[0, 0] < inner:
                above = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + above
            margin = margin + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost complete trees on the log loss, splitting at bin edges by second-order gain."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base, inner = float(np.log(share / (1 - share))), 2**DEPTH - 1
    none = Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(y) or y.min() == y.max():
        return none
    n_features = x.shape[1]
    edges = [
        np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1], method="lower"))
        for f in range(n_features)
    ]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    cell = binned + BINS * np.arange(n_features)  # row's cell in each feature's histogram
    cells = BINS * n_features
    margin = np.full(len(y), base)
    feature, threshold, leaf = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        chosen, cut = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * cells + cell).ravel()
            shape = (width, n_features, BINS)
            g = np.bincount(at, np.repeat(gradient, n_features), width * cells).reshape(shape)
            h = np.bincount(at, np.repeat(curvature, n_features), width * cells).reshape(shape)
            left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = (
                left_g**2 / (left_h + PENALTY)
                + right_g**2 / (right_h + PENALTY)
                - all_g**2 / (all_h + PENALTY)
            )
            gain[(left_h < MIN_CURVATURE) | (right_h < MIN_CURVATURE)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            best_bin = np.full(width, BINS)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    chosen[first + k], cut[first + k], best_bin[k] = f, edges[f][b], b
            own = node - first
            above = binned[np.arange(len(y)), chosen[node]] > best_bin[own]
            node = 2 * node + 1 + above
        own = node - inner
        g = np.bincount(own, gradient, inner + 1)
        h = np.bincount(own, curvature, inner + 1)
        value = -RATE * g / (h + PENALTY)
        margin = margin + value[own]
        feature.append(chosen)
        threshold.append(cut)
        leaf.append(value)
    return Trees(base, np.array(feature), np.array(threshold), np.array(leaf))


def held_out(key: Column) -> Column:
    """Rows whose labels a fit never sees: a third of the ids, by their checksum."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    seed: int = 42,
) -> Trees:
    """Fit on the labelled rows that are not held out.

    With more than ``fit_rows`` of them, a row takes part if a seeded hash of its id falls
    below ``fit_rows`` / rows, so about ``fit_rows`` ids are sent to all tasks and as many
    rows of statistics come back.
    """
    short_batches(docs.sparkSession)
    key = F.col(id_col)
    known = (
        labels.filter(~held_out(key) & key.isNotNull())
        .groupBy(id_col)
        .agg(F.avg(label_col).alias("y"))
        .filter("y is not null")
    )
    share = min(1.0, fit_rows / max(1, known.count()))
    drawn = known.filter(uniform(id_col, seed) < share)
    texts = docs.select(id_col, text_col).join(F.broadcast(drawn), id_col)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            found = map(statistics, columns[text_col].to_pylist())
            yield {"y": columns["y"], "x": [np.asarray(x, "<f8").tobytes() for x in found]}

    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("x", T.BinaryType())])
    rows = map_rows(texts.select(text_col, "y"), work, schema).collect()
    rows.sort(key=lambda r: (r.x, r.y))  # the fit does not depend on the order of arrival
    x = np.array([np.frombuffer(r.x, "<f8") for r in rows]).reshape(-1, len(STATISTICS))
    return fit_trees(x, np.array([r.y for r in rows]).round())


def score(df: DataFrame, model: Trees, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 of each row's whole text."""
    short_batches(df.sparkSession)
    kept = [c for c in df.columns if c != out]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            texts = columns[text_col].to_pylist()
            x = np.array(list(map(statistics, texts))).reshape(-1, len(STATISTICS))
            yield {**columns, out: pa.array(model.score(x))}

    schema = T.StructType([*fields(df, *kept), T.StructField(out, T.DoubleType())])
    return map_rows(df.select(kept), work, schema)
