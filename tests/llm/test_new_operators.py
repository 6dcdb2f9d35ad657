"""Passages, source differences and hard negatives against brute force, with their edge cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.llm import divergence, negatives, phrase_dedup

# --- passages -------------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, begin int, key string, content string, n int, words string"


def _docs(spark, rows):
    """Documents with columns named as the operator's own."""
    return spark.createDataFrame([(i, t, 1, "k", "c", 2, "w") for i, t in rows], DOCS)


def _plain(texts, length):
    """``(n_words, kept)`` of each text."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(5)
    make = lambda n, v=400: [f"w{rng.randrange(v)}é" for _ in range(n)]
    shared, short = make(30), make(9)
    texts = [" ".join(make(60)) for _ in range(6)]
    for i in range(25):  # one passage in different surroundings: one phrase, many stretches
        texts.append(" ".join(make(rng.randrange(12)) + shared[: 22 + i % 9] + make(rng.randrange(12))))
    copy = make(50)
    texts += [" ".join(copy)] * 7 + [" ".join(copy[:20] + ["x"] + copy[21:])]
    texts += [" ".join(make(5) + short + make(5)), " ".join(make(4) + short)]
    inside = make(14)
    texts += [" ".join(inside + make(3) + inside), "a " * 60, "b\x0bc\n" * 20, "", None, "only few"]
    texts += [" ".join(make(40)), " ".join(make(4000, 5000))]
    return texts


@pytest.mark.parametrize("length, phrase, group, windows", [(10, 4, 1000, 50), (10, 3, 2, 20_000), (35, 8, 3, 7)])
def test_passages_equal_brute_force(spark, passages, length, phrase, group, windows):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(passages)] + [(1, passages[1])] * 2
    found = phrase_dedup.remove_repeated(
        _docs(spark, rows).repartition(3), length=length, phrase=phrase, group=group, shard_windows=windows
    ).collect()
    wanted = Counter((i, *x) for (i, _), x in zip(rows, _plain([t for _, t in rows], length)))
    assert Counter((r.doc_id, r.n_words, bytes(r.kept)) for r in found) == wanted
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_words - len(r.kept.split()) for r in found)
    if length == 10:
        assert sum(bool(r.spans) for r in found) > 30


def test_no_documents(spark):
    assert phrase_dedup.remove_repeated(_docs(spark, []).filter("false")).count() == 0


def test_stretches_hold_every_window_once():
    codes = phrase_dedup.Words().codes([b"a", b"b"] * 40 + [b"x%d" % i for i in range(60)])
    key, begin, windows, content = phrase_dedup.stretches(codes, 35, 8)
    assert begin[0] == 0 and (begin[1:] == (begin + windows)[:-1]).all()
    assert windows.sum() == len(codes) - 34 and windows.max() <= 28


# --- sources --------------------------------------------------------------------------------


def _audit(rows, min_docs, top):
    """Plain counting of everything."""
    texts = [(a or "", b or "", _terms(t)) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in texts}:
        own = [(b, t) for a, b, t in texts if a == lang]
        docs = Counter(x for _, t in own for x in set(t))
        kept = {x for x, n in docs.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for b, t in own:
            counts[b].update(x for x in t if x in kept)
        whole = sum(counts.values(), Counter())

        def p(c, x):
            return 1 + 1_000_000_000 * (c[x] + 5) // (sum(c.values()) + 5 * len(kept))

        for b in counts:
            pairs = [(o, sum(abs(p(counts[b], x) - p(counts[o], x)) for x in kept)) for o in counts if o != b]
            terms = [(x, p(counts[b], x) - p(whole, x)) for x in kept if counts[b][x]]
            for part, found in (("pair", pairs), ("term", [t for t in terms if t[1] > 0])):
                ranked = sorted(found, key=lambda f: (-f[1], f[0].encode()))
                if part == "term":
                    ranked = ranked[:top]
                out += [(lang, b, part, x, v, i + 1) for i, (x, v) in enumerate(ranked)]
    return sorted(out)


def _terms(text):
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)


SOURCES = "lang string, source string, text string, term string, n int, part string"


def test_sources_equal_plain_counting(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        words = [f"T{int(rng.paretovariate(0.6)) % 150}ÀÉ{'abc'[i % 3]}" for _ in range(rng.randrange(40))]
        words = [w.replace("1", "x").replace("2", "y") for w in words]
        rows.append((rng.choice(["en", "fr", None]), f"s{rng.randrange(40)}", " ".join(words)))
    rows += [("en", None, "Aa aA-aa zz9zz"), ("xx", "alone", None), ("xx", "other", "")] + [rows[0]] * 3
    rows += [("long", "a", "ab cd " * 30_000), ("long", "b", None)]
    df = spark.createDataFrame([(*r, "t", 1, "p") for r in rows], SOURCES).repartition(3)
    # Small blocks, tiles and parts: sources and terms meet in many tasks.
    for name, value in (("BLOCK_TERMS", 16), ("TILE", 7), ("PART_TERMS", 32), ("HELD_TERMS", 50)):
        monkeypatch.setattr(divergence, name, value)
    found = divergence.audit(df, min_docs=3, top=4)
    names = ("lang", "source", "part", "item", "value", "rank")
    got = sorted(tuple(r[n] for n in names) for r in found.collect())
    assert got == _audit(rows, 3, 4)
    assert divergence.audit(df.filter("false")).count() == 0


def test_no_kept_terms(spark):
    df = spark.createDataFrame([("en", s, "one two") for s in "ba"], "lang string, source string, text string")
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)
    ]


# --- negatives ------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, q string, part int, row int, id string"


def _mine(rows, anchors, positives=5, take=3):
    rows = {(i, l, tuple(int(np.floor(256.0 * x)) for x in v)) for i, v, l in rows
            if i is not None and l is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)}
    clamp = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    score = lambda a, b: clamp(sum(x * y for x, y in zip(a[2], b[2])))
    out = []
    for a in rows:
        if not anchors(a[0]):
            continue
        others = [(-score(a, r), r[0], r) for r in rows if r != a and len(r[2]) == len(a[2])]
        near = sorted(x for x in others if x[2][1] == a[1])[:positives]
        for p, i, _ in near:
            p = -p
            inside = sorted(x for x in others if x[2][1] != a[1] and 50 * p <= 100 * -x[0] <= 95 * p)
            out += [(a[0], i, k + 1, j, p, -s) for k, (s, j, _) in enumerate(inside[:take])]
    return sorted(out)


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 60)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        label = int(rng.integers(0, 4))
        v = rng.normal(0, 0.3, 20) + np.eye(20)[label]
        rows.append((i, [float(x) for x in np.round(v, 1 if i % 2 else 3)], label))
    rows += [(1000 + i, rows[i % 3][1], 1) for i in range(30)]  # ties
    rows += [rows[0], rows[0], (50, rows[9][1], 3)]  # a repeated row, an id with two vectors
    rows += [(None, rows[1][1], 1), (2000, None, 1), (2001, [0.1] * 20, None), (2002, [float("nan")] * 20, 1)]
    rows += [(2003, [0.1] * 19 + [None], 1), (2004, [float("inf")] + [0.1] * 19, 1), (2050, [], 1), (2051, [], 2)]
    rows += [(2100, [0.5, 1.5], 1), (2101, [0.5, 1.4], 1), (2102, [0.5, 1.0], 2), (3000, [0.0] * 20, 7)]
    df = spark.createDataFrame([(*r, "q", 1, 2, "x") for r in rows], VECTORS).repartition(3)
    found = negatives.mine(df, F.col("id") % 50 == 0)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = sorted(tuple(r[n] for n in names) for r in found.collect())
    assert got == _mine(rows, lambda i: i % 50 == 0) and len(got) > 80
    assert negatives.mine(df.filter("false"), F.col("id") % 50 == 0).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e18, 1.0], 1), (1, [1e18, 2.0], 1), (2, [-1e30, 2.0], 1), (3, [9e-19, 0.1], 2), (4, [5.0, 0.0], 2),
            (50, [1e7, 3.5], 1), (51, [1e5, 3.5], 2), (52, [9e6, 0.5], 3)]
    df = spark.createDataFrame([(*r, "q", 1, 2, "x") for r in rows], VECTORS)
    got = sorted(tuple(r) for r in negatives.mine(df, F.col("id") % 50 == 0).collect())
    assert got == _mine(rows, lambda i: i % 50 == 0)


def test_a_scan_drops_rows_before_the_last_column():
    rng = np.random.default_rng(0)
    columns = rng.integers(-50, 50, (64, 500)).astype(float)
    anchor = np.zeros(64)
    anchor[:4] = 100.0
    ends = columns.min(1), columns.max(1)
    at, scores = negatives.scan(columns, ends, np.arange(500), np.arange(500), anchor, [(-(10**9), 10**9)], 5)[0]
    exact = anchor @ columns
    assert scores == sorted(exact.astype(int).tolist(), reverse=True)[:5] and (exact[at] == scores).all()
