"""Suffix arrays by induced sorting, and permuted common prefixes, in array operations.

Induction scans the array once in each direction; a scan takes as many entries at a time as
do not feed one another, so its steps are array operations over long stretches.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. ``t`` ends in its unique smallest
    symbol, whose suffix counts as smaller."""
    n = len(t)
    step = (t[1:] > t[:-1]).astype(np.int8) - (t[1:] < t[:-1])
    # Within a run of one symbol, what ends the run decides.
    at = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n))
    at = np.minimum.accumulate(at[::-1])[::-1]
    smaller = np.ones(n, bool)
    smaller[:-1] = step[np.minimum(at, n - 2)] > 0
    return smaller


def _ranks(sorted_keys: np.ndarray) -> np.ndarray:
    """Place of each entry among the equal ones before it, in a grouped array."""
    n = len(sorted_keys)
    first = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    return np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))


def _scan(sa: np.ndarray, t: np.ndarray, wanted: np.ndarray, edge: np.ndarray, step: int) -> None:
    """Induce the suffixes ``wanted`` from their successors, filling buckets from ``edge``.

    ``step`` 1 goes left to right and fills buckets from their heads, -1 the other way.
    """
    n, size = len(sa), 1024
    at = 0 if step == 1 else n
    while 0 <= at and (at < n if step == 1 else at > 0):
        low, high = (at, min(at + size, n)) if step == 1 else (max(at - size, 0), at)
        places = np.arange(low, high) if step == 1 else np.arange(high - 1, low - 1, -1)
        before = sa[places] - 1
        use = before >= 0
        use[use] = wanted[before[use]]
        before, writer = before[use], places[use]
        stop = high if step == 1 else low - 1
        if len(before):
            symbol = t[before]
            order = np.argsort(symbol, kind="stable")
            before, writer, symbol = before[order], writer[order], symbol[order]
            to = edge[symbol] + step * _ranks(symbol)
            # Entries written inside this stretch must be read before what follows them.
            inside = to[(to < high) if step == 1 else (to >= low)]
            if len(inside):
                stop = inside.min() if step == 1 else inside.max()
                ready = writer < stop if step == 1 else writer > stop
                before, symbol, to = before[ready], symbol[ready], to[ready]
            sa[to] = before
            edge += step * np.bincount(symbol, minlength=len(edge)) if len(edge) < 2048 else 0
            if len(edge) >= 2048:
                np.add.at(edge, symbol, step)
        done = abs(stop - at) if step == 1 else at - 1 - stop
        size = min(size * 2, 1 << 20) if done >= size else max(64, 2 * done)
        at = stop if step == 1 else stop + 1


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array given the leftmost-smaller suffixes ``lms`` grouped by symbol, in order."""
    sa = np.full(len(t), -1, np.int32)
    heads = np.concatenate(([0], ends[:-1]))

    def place() -> None:
        symbol = t[lms][::-1]
        sa[ends[symbol] - 1 - _ranks(symbol)] = lms[::-1]

    place()
    _scan(sa, t, ~smaller, heads.copy(), 1)
    sa[1:][smaller[sa[1:]] & (sa[1:] >= 0)] = -1
    _scan(sa, t, smaller, ends - 1, -1)
    return sa


def _names(t: np.ndarray, order: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Number the sorted leftmost-smaller substrings, equal ones alike."""
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        x, y = a[live], b[live]
        equal = t[x + k] == t[y + k]
        same[live[~equal]] = False
        live = live[equal & (length[x] > k + 1)]
        k += 1
    return np.concatenate(([0], np.cumsum(~same)))


def _double(t: np.ndarray) -> np.ndarray:
    """Suffix array by doubling the length that is sorted: for names of which most differ, whose
    buckets are too small for induction to take long stretches."""
    n, k, rank = len(t), 1, t.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)
        new = key[order][1:] != key[order][:-1]
        if new.all():
            return order
        rank[order] = np.concatenate(([0], np.cumsum(new)))
        k *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``t`` in order; ``t`` ends in its unique smallest symbol, 0.

    Symbols of 16 bits are induced, with a counting sort; the recursion ends at wider names.
    """
    n = len(t)
    if n < 3:
        return np.arange(n)[::-1].copy()
    if t.dtype != np.uint16:
        return _double(t)
    smaller = _types(t)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    ends = np.cumsum(np.bincount(t))
    grouped = starts[np.argsort(t[starts], kind="stable")]
    sa = _induce(t, smaller, grouped, ends)
    is_start = np.zeros(n, bool)
    is_start[starts] = True
    order = sa[is_start[sa]]
    length = np.zeros(n, np.int64)
    length[starts] = np.append(starts[1:], n - 1) - starts + 1
    names = _names(t, order, length)
    if names[-1] + 1 < len(order):
        named = np.zeros(n, np.uint16 if names[-1] < 1 << 16 else np.int32)
        named[order] = names
        order = starts[suffix_array(named[starts])]
    return _induce(t, smaller, order, ends)


#: An explicit comparison at least at every so many positions bounds its length.
STRIDE = 256


def joined(t: np.ndarray, sa: np.ndarray, least: int) -> np.ndarray:
    """For each place of the suffix array, whether its suffix shares ``least`` symbols with
    the one before.

    Common prefixes are permuted to text order, where they shrink by one at most from one
    position to the next: only positions that do not extend the match of the one before are
    compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    p = np.arange(n)
    extends = (p > 0) & (before > 0) & (p % STRIDE != 0)
    extends[extends] = t[p[extends] - 1] == t[before[extends] - 1]
    # A position extends a match only of what its own predecessor was compared with.
    inner = np.flatnonzero(extends)
    extends[inner] = before[inner - 1] == before[inner] - 1
    explicit = np.flatnonzero(~extends)
    most = least + STRIDE
    common = np.zeros(n, np.int64)
    live = explicit[before[explicit] >= 0]
    x, y, k = live, before[live], 0
    while len(live) and k < most:
        # The last symbol occurs once, so two different suffixes differ before the end.
        equal = t[x + k] == t[y + k]
        common[live[~equal]] = k
        live, x, y = live[equal], x[equal], y[equal]
        k += 1
    common[live] = k
    last = np.maximum.accumulate(np.where(extends, -1, p))
    common = np.maximum(common[last] - (p - last), 0)
    return common[sa] >= least
