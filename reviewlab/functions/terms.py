"""Tokens, n-grams and per-row term counts as array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from reviewlab.functions.text import _col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(normal: Column | str, min_len: int = 2) -> Column:
    """Words of at least ``min_len`` characters of a text that ``normalize_tokens`` made."""
    return F.filter(F.split(_col(normal), " "), lambda t: F.length(t) >= min_len)


def ngrams(words: Column, lo: int = 1, hi: int = 2) -> Column:
    """All ``lo``- to ``hi``-grams over neighbouring kept words, joined by a space."""
    if lo < 1 or hi < lo:
        raise ValueError("n-gram range must satisfy 1 <= lo <= hi")
    empty = F.array().cast("array<string>")

    def of_size(ws: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - n)
        grams = F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.get(ws, i + j) for j in range(n)])
        )
        return F.when(F.size(ws) >= n, grams).otherwise(empty)

    def every_size(ws: Column) -> Column:
        return F.concat(*[ws if n == 1 else of_size(ws, n) for n in range(lo, hi + 1)])

    return let(words, every_size)


def count_terms(terms: Column) -> Column:
    """Distinct terms of one row with their counts, as ``array<struct<term, tf>>``.

    Sorting the row's own array and cutting it into runs needs no shuffle and stays
    n log n for the longest document.
    """

    def runs(s: Column) -> Column:
        n = F.size(s)
        at = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(
            at,
            lambda first: F.transform(
                first,
                lambda i, j: F.struct(
                    F.get(s, i).alias("term"),
                    (F.coalesce(F.get(first, j + 1), n) - i).alias("tf"),
                ),
            ),
        )

    none = F.array().cast("array<struct<term:string,tf:int>>")
    return let(F.sort_array(terms), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))
