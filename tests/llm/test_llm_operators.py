"""Each operator against a brute-force version or by its edge cases, on small tables."""

import hashlib
import random
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlab.llm import (
    bpe,
    decontaminate,
    licenses,
    line_dedup,
    near_dedup,
    quality_model,
    quality_rules,
    secrets,
    suffix_array,
    suffix_dedup,
    url_filter,
)

DOCS = "doc_id long, text string, source string, n_words string, salt string"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def docs_of(spark, rows):
    """A table with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], DOCS)


EDGE = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n ", None),
    (None, "some words without an id", "b"),
    (4, "one", "a"),
    (5, "same text twice in the table", "a"),
    (5, "same text twice in the table", "a"),
    (6, "long " * 30_000, "c"),
    (7, "日本語 ünï – 😀", "c"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return docs_of(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def rng():
    return random.Random(7)


# --- encoding --------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, edge):
    library = Tokenizer.from_file(WORD_BPE)
    alphabet = "abcdeSTl'’ \t\n\x1c\x85  ​12½ⅣÄİΣς̧́é日ไ😀-_=<|>.,!%"
    rng = random.Random(1)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(500)]
    texts += ["<|endoftext|>x<|startoftext|>", "<|ENDOFTEXT|>", "a" * 5000, "I'll it's 's"]
    rows = [(i, t, "s") for i, t in enumerate(texts, 100)] + EDGE
    done = bpe.round_trip(docs_of(spark, rows), WORD_BPE).collect()
    assert len(done) == len(rows)
    found = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in done)
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i, array("I", ids).tobytes(), decoded]


def test_bpe_decodes_what_it_encodes(spark, edge, empty):
    coded = bpe.encode(edge, WORD_BPE)
    both = bpe.decode(coded, WORD_BPE).collect()
    assert {r.decoded for r in both} == {r.decoded for r in bpe.round_trip(edge, WORD_BPE).collect()}
    assert bpe.round_trip(empty, WORD_BPE).count() == 0


def test_bpe_refuses_merges_out_of_order():
    spec = """{"model": {"end_of_word_suffix": "</w>", "vocab": {"a": 0, "b": 1, "ab": 2, "abb": 3},
     "merges": ["ab b", "a b"]}, "added_tokens": []}"""
    with pytest.raises(ValueError):
        bpe.WordVocabulary(spec)


# --- quality rules ----------------------------------------------------------------------------


def test_quality_rules_measure(spark, edge, empty):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [
        (10, "a b c a b c x", "s"),
        (11, "l1\nl1\n\n \nl2", "s"),
        (12, " ".join(words) + " the of and to in a is", "s"),
        (13, "spam spam spam " * 30, "s"),
    ]
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs_of(spark, rows)).collect()}
    assert (got[10].n_words, got[10].n_repeat_words, got[10].word_chars) == (7, 6, 7)
    assert (got[11].n_dup_lines, got[11].n_lines) == (1, 3)
    assert got[12].n_stop_words == 7 and not got[12].base_failed and got[12].kept
    assert got[13].base_failed and not got[13].kept and got[13].n_repeat_words == 90
    edges = quality_rules.apply_rules(edge)
    assert edges.count() == len(EDGE)
    assert {r.n_words for r in edges.filter("doc_id <= 3").collect()} == {0}
    assert quality_rules.apply_rules(empty).count() == 0


# --- licences ---------------------------------------------------------------------------------


def test_licences(spark, edge, empty):
    grant = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
        'of this software and associated documentation files (the "Software"), to deal\n'
        "in the Software without restriction, including without limitation the rights\n"
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
        "copies of the Software, and to permit persons to whom the Software is\n"
        "furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all\n"
        "copies or substantial portions of the Software.\n\n"
    )
    warranty = (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\n'
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n"
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ).replace("OR\nIMPLIED", "OR IMPLIED")
    rows = [
        (10, grant + warranty, "s"),
        (11, grant, "s"),
        (12, "Text.\nLicensed under the Apache License, Version 2.0.\nMIT License. End.", "s"),
        (13, "A licensed fool.", "s"),
    ]
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got[10].sentences == ["mit-grant", "mit-notice", "mit-as-is"]
    assert got[10].licences == ["MIT"]
    assert got[11].licences == []  # a part of the sequence is no licence
    assert got[12].licences == ["Apache-2.0", "MIT"]
    assert got[13].sentences == []
    assert licenses.scan(edge).filter("size(licences) > 0").count() == 0
    assert licenses.scan(empty).count() == 0
    import re

    assert all(re.search(licenses.STEMS, s) for s in licenses.SENTENCES.values())


# --- lines ------------------------------------------------------------------------------------


def test_shared_lines_go(spark, empty):
    shared, local, short = "all rights are reserved here", "only one site says this", "ok"
    rows = [(i, f"own line number {i} here\n{shared}\n{short}\n{shared}", f"s{i % 12}") for i in range(24)]
    rows += [(100 + i, f"{local}\nx", "s1") for i in range(30)]
    rows += [(200, shared, None), (201, None, "s1"), (5, rows[5][1], rows[5][2])]
    got = line_dedup.drop_shared_lines(docs_of(spark, rows))
    assert got.columns == ["doc_id", "text", "source", "n_words", "salt", "n_lines", "n_removed"]
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    assert [r.text for r in by[5]] == [f"own line number 5 here\n{short}"] * 2
    assert (by[5][0].n_lines, by[5][0].n_removed) == (4, 2)
    assert by[103][0].text == f"{local}\nx"
    assert by[200][0].text == "" and by[201][0].text is None
    assert line_dedup.drop_shared_lines(empty).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [
        (s * 100 + i, f"this line has {s} sites exactly", f"site{i % s}")
        for s in range(5, 16)
        for i in range(40)
    ]
    got = line_dedup.drop_shared_lines(docs_of(spark, rows)).filter("n_removed > 0").collect()
    assert {r.doc_id // 100 for r in got} == set(range(10, 16))


def test_salted_shuffle_gives_the_same_lines(spark, monkeypatch):
    rows = [(i, f"a line that everybody has\nnumber {i} of this table", f"s{i % 20}") for i in range(60)]
    docs = docs_of(spark, rows)
    want = sorted(line_dedup.drop_shared_lines(docs).collect())
    monkeypatch.setattr(line_dedup, "SMALL_LINES", 0)
    assert sorted(line_dedup.drop_shared_lines(docs).collect()) == want
    assert {r.n_removed for r in want} == {1}


# --- repeated strings -------------------------------------------------------------------------


def brute_repeats(texts, length):
    seen = defaultdict(list)
    raws = [(t or "").encode() for t in texts]
    for k, raw in enumerate(raws):
        for p in range(len(raw) - length + 1):
            seen[raw[p : p + length]].append((k, p))
    covered = [np.zeros(len(raw), bool) for raw in raws]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                covered[k][p : p + length] = True
    return covered


def repeat_rows():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(300)]
    part = " ".join(rng.choices(words, k=30))
    rows = []
    for k in range(120):
        head, tail = (" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in "ab")
        rows.append((k, f"{head} {part[rng.randint(0, 20):] if k % 2 else ''}{tail}", "s"))
    rows += [(1000 + k, rows[k][1], "s") for k in range(0, 40, 3)] + [rows[3], rows[3]]
    rows += [(2000 + k, rows[k][1][:-3] + "#" + rows[k][1][-2:], "s") for k in range(20)]
    return rows + [(3000, "a" * 700, "s"), (3001, "ab" * 300, "s"), (3002, "é" * 200, "s")] + EDGE[:6]


@pytest.mark.parametrize("shard", [2_000_000, 3_000, 600])
def test_repeated_strings_against_brute_force(spark, shard):
    rows = repeat_rows()
    got = suffix_dedup.remove_repeated(docs_of(spark, rows), length=40, gram=8, shard_bytes=shard)
    want = []
    for (i, text, _), flags in zip(rows, brute_repeats([t for _, t, _ in rows], 40)):
        raw = (text or "").encode()
        kept = bytes(b for b, f in zip(raw, flags) if not f)
        want.append((str(i), len(raw), suffix_dedup._flagged_runs(flags), kept))
    found = [
        (str(r.doc_id), r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got.collect()
    ]
    assert sorted(found) == sorted(want)


def test_repeated_strings_of_an_empty_table(empty):
    assert suffix_dedup.remove_repeated(empty).count() == 0


def test_suffix_arrays_against_sorting():
    rng = np.random.default_rng(1)
    for trial in range(300):
        n, k = int(rng.integers(1, 150)), int(rng.integers(1, 6))
        t = rng.integers(1, k + 1, n)
        if trial % 3 == 0:
            t = np.tile(t[: max(1, n // 7)], 8)[:n]
        t = np.append(t, 0).astype(np.uint16 if trial % 2 else np.int64)
        sa, text = suffix_array.suffix_array(t), t.tolist()
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        least = int(rng.integers(1, 8))
        same = [False] + [
            text[a : a + least] == text[b : b + least] and max(a, b) + least <= len(text)
            for a, b in zip(sa, sa[1:])
        ]
        assert suffix_array.joined(t, sa, least).tolist() == same


# --- secrets ----------------------------------------------------------------------------------


def scan_secrets(df):
    return secrets.scan(
        df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def test_secrets(spark, edge, empty):
    key, sha = "q7Xb2LmP9vKt4RzW8sYd3NcF", hashlib.sha1(b"x").hexdigest()
    rows = [
        (10, f"é token = \"{sha}\" end", "s"),
        (11, "PASSWORD: short1 secret=longenough1 AKIAABCDEFGHIJKL AKIASHORT", "s"),
        (12, f"key {key} and {sha.upper()} and 123e4567-e89b-12d3-a456-426614174000", "s"),
        (13, "internationalisation_of_words_2 donaudampfschifffahrtsgesellschaft1", "s"),
        (14, "api_ſecret=abcdefgh1 to\u212aen=abcdefgh1", "s"),
    ]
    got = {
        r.doc_id: [(s.kind, s.begin, s.end) for s in r.spans]
        for r in scan_secrets(docs_of(spark, rows)).collect()
    }
    assert got[10] == [("assign", 2, 51), ("hex", 11, 51)]
    assert got[11] == [("assign", 17, 35), ("access", 36, 52)]
    assert got[12] == [("random", 4, 28)]
    assert got[13] == got[14] == []
    assert scan_secrets(edge).filter("size(spans) > 0").count() == 0
    assert scan_secrets(empty).count() == 0


# --- benchmark --------------------------------------------------------------------------------


def brute_items(rows, items, window):
    found = []
    cut = {i: [t.decode() for t in decontaminate.terms_of(x)] for i, x in items}
    for i, text, _ in rows:
        words = [t.decode() for t in decontaminate.terms_of(text)]
        hit, names = set(), set()
        for item, terms in cut.items():
            k = min(window, len(terms))
            for a in range(len(terms) - k + 1 if k else 0):
                for p in range(len(words) - k + 1):
                    if words[p : p + k] == terms[a : a + k]:
                        hit |= set(range(p, p + k))
                        names.add(str(item))
        found.append((str(i), len(words), len(hit), sorted(names)))
    return sorted(found)


def test_items_against_brute_force(spark, empty):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, text(rng.randint(1, 12))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "W1-w2!W3"), (3, items[3][1])]
    rows = [(i, f"{text(9)} Zz {items[i % 25][1]} yy {text(5)}", "s") for i in range(60)] + EDGE
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(docs_of(spark, rows), table, window=5).collect()
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got)
    assert found == brute_items(rows, items, 5)
    assert decontaminate.find_items(empty, table).count() == 0
    none = decontaminate.find_items(docs_of(spark, rows), table.limit(0)).collect()
    assert {r.n_hit for r in none} == {0}


def test_items_in_several_groups(spark, monkeypatch):
    items = [(i, " ".join(f"t{i}x{k}" for k in range(15))) for i in range(8)]
    rows = [(i, f"before {items[i][1]} between {items[7 - i][1]} after", "s") for i in range(8)]
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "GROUP_WORDS", 30)
    got = decontaminate.find_items(docs_of(spark, rows), table).collect()
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got)
    assert found == brute_items(rows, items, 13)


def test_close_words_are_found_with_slack(spark):
    table = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    rows = [
        (1, "x beta alpha gamma foreign delta epsilon y", "s"),
        (2, "alpha beta gamma one two three four delta epsilon", "s"),
    ]
    docs = docs_of(spark, rows)
    got = {r.doc_id: r.n_hit for r in decontaminate.find_items(docs, table, slack=1).collect()}
    assert got[1] == 6 and got[2] == 0
    assert decontaminate.find_items(docs, table).filter("n_hit > 0").count() == 0


def test_contaminated_documents_go(spark):
    items = spark.createDataFrame([(1, " ".join(f"k{i}" for i in range(20)))], "item_id long, text string")
    passage = " ".join(f"k{i}" for i in range(3, 18))
    rows = [(1, passage, "s"), (2, passage + " z" * 400, "s"), (None, passage, "s"), (4, None, "s")]
    left = decontaminate.drop_contaminated(docs_of(spark, rows), items).collect()
    assert {r.doc_id for r in left} == {2, 4}


# --- quality model ----------------------------------------------------------------------------


def test_trees_learn_and_score(spark, edge, empty):
    rng = random.Random(2)
    words = ["river", "stone", "the", "of", "walks", "green", "under", "and", "a", "light"]
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.6
        text = " ".join(w if good else w + rng.choice(["%%%", "$$$"]) for w in rng.choices(words, k=40))
        rows.append((i, text, "s"))
        labels.append((i, int(good)))
    table = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    model = quality_model.fit(docs, table)
    scored = quality_model.score(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    truth = dict(labels)
    out = scored.filter(quality_model.held_out(scored.doc_id)).collect()
    assert 80 < len(out) < 190
    assert all((r.score >= 0.5) == bool(truth[r.doc_id]) for r in out)
    edges = quality_model.score(edge, model).collect()
    assert len(edges) == len(EDGE) and all(0 <= r.score <= 1 for r in edges)
    assert quality_model.score(empty, model).count() == 0
    none = quality_model.fit(docs, table.limit(0))
    assert {r.score for r in quality_model.score(edge, none).collect()} == {0.5}


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    trees = quality_model.fit_trees(x, y)

    def walk(row):
        margin = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > t[node])
            margin += leaf[node - len(f)]
        return 1 / (1 + np.exp(-margin))

    assert np.allclose(trees.score(x), [walk(r) for r in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


# --- near duplicates --------------------------------------------------------------------------


def brute_groups(rows, size, percent):
    def shingles(text):
        words = (text or "").encode().lower().split()
        if not words:
            return frozenset()
        k = min(size, len(words))
        return frozenset(tuple(words[a : a + k]) for a in range(len(words) - k + 1))

    sets = {i: shingles(t) for i, t, _ in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_brute_force(spark, size):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(25):
        base = rng.choices(words, k=rng.randint(1, 120))
        for c in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.randint(0, 1 << 40), " ".join(copy), "s"))
    rows += EDGE
    got = near_dedup.near_duplicates(docs_of(spark, rows), size=size).collect()
    want = brute_groups(rows, size, 80)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    kept = near_dedup.keep_first(docs_of(spark, rows), size=size)
    assert {r.doc_id for r in kept.collect()} == {None} | {c for _, c in want.values()}


def test_members_the_leader_leaves_apart_are_linked(spark, monkeypatch):
    # 1 is the leader; 2 and 3 are near each other, 5 is near 4 of the leader's group.
    text = {1: range(10), 2: range(20, 30), 3: range(20, 31), 4: range(100, 110), 5: range(99, 110)}
    sets = [
        (i, np.fromiter(w, np.uint64).tobytes(), np.fromiter(w, np.uint32).tobytes())
        for i, w in text.items()
    ]
    sets = spark.createDataFrame(sets, "id long, set binary, short binary")
    buckets = spark.createDataFrame(
        [(7, i, 1, 5) for i in text], "key long, id long, leader long, n long"
    )
    groups = spark.createDataFrame([(1, 1), (4, 1)], "id long, component long")
    unsettled = near_dedup._unsettled(buckets, groups)
    pairs = near_dedup._remaining_pairs(unsettled)
    assert {tuple(p) for p in pairs.collect()} == {
        (2, 3), (2, 4), (3, 4), (4, 5), (2, 5), (3, 5),
    }
    assert near_dedup._tile_pairs(unsettled, sets, 80).count() == 0
    want = {(2, 3), (4, 5)}
    assert {tuple(p) for p in near_dedup.verified(pairs, sets, 80).collect()} == want
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 1)
    monkeypatch.setattr(near_dedup, "TILE", 2)
    links = near_dedup._tile_pairs(unsettled, sets, 80)
    assert {tuple(p) for p in links.collect()} == want
    assert near_dedup._remaining_pairs(unsettled).count() == 0


def test_near_duplicates_of_an_empty_table(empty):
    assert near_dedup.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99)], "u long, v long")
    got = {r.id: r.component for r in near_dedup.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 99: 99, 100: 99}


def test_signatures_are_super_minhashes():
    """Every shingle deals each slot once, and signatures estimate similarity closely."""
    rng = np.random.default_rng(3)

    def slow(s, slots):
        out = [1 << 64] * slots
        for x in s:
            ranks = list(range(slots))
            for j in range(slots):
                fraction, k = near_dedup._draw(np.array([x], np.uint64), j, slots)
                ranks[j], ranks[k[0]] = ranks[k[0]], ranks[j]
                out[ranks[j]] = min(out[ranks[j]], j << 32 | int(fraction[0]))
        return out

    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 3, 40, 200)]
    fast = near_dedup.signatures(sets, 16)
    assert [list(map(int, row)) for row in fast] == [slow(s, 16) for s in sets]


# --- addresses --------------------------------------------------------------------------------

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("a.b.net", "/es/x", "allow"), ("example.com", "/en/x/y", "allow"),
]


def judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:end].lower(), rest[end:].split("#")[0].split("?")[0]
    fits = [
        (h + p, v)
        for h, p, v in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, verdict


@pytest.fixture
def partitions(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.set(name, before)


@pytest.mark.parametrize("ranges", [1, 8, 40])
def test_url_rules(spark, partitions, ranges):
    partitions(ranges)
    rng = random.Random(6)
    hosts = ["example.com", "www.EXAMPLE.com", "notexample.com", "com", "a.b.net", "b.net", "x.org",
             "example.com.net", "a-b.net", "a.b.net.", ""]
    paths = ["", "/", "/en", "/en/", "/en/x/y/z", "/es/x", "/es/", "?q=/en/", "#/en/", "/EN/"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "example.com/en/", "http://example.com/en/a?b://c", "://com/"]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(None, "http://com/", "x"), (0, urls[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_filter.match_rules(pages, rules).collect()
    assert len(got) == len(rows)
    want = Counter((str(i), *judge(u)) for i, u, _ in rows)
    assert Counter((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in got) == want
    none = url_filter.match_rules(pages, rules.limit(0)).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")}
    assert url_filter.match_rules(pages.limit(0), rules).count() == 0


def test_rules_reach_every_range_they_are_open_in(spark, partitions):
    """Many rules, nested and beside one another, a hot host over many ranges, odd rules."""
    partitions(24)
    rng = random.Random(8)
    labels = ["a", "ab", "b", "c-d", "é", "z"]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(1500)]
    listed = [(h, rng.choice(["", "/", "/x", "/x/y"]), rng.choice(["allow", "block"])) for h in hosts[:600]]
    odd = [(None, "/", "block"), ("", "/", "block"), ("z", "/q", None), ("Z", None, "block")] + listed[:3]
    urls = [f"http://{h}{rng.choice(['', '/', '/x/z', '/x/y/z'])}" for h in hosts * 2]
    urls += [f"http://a.b/x/{i}" for i in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "key long, url string")
    rules = spark.createDataFrame(listed + odd, "host string, path string, verdict string")
    got = {r.key: (r.rule, r.verdict) for r in url_filter.match_rules(pages, rules, "key").collect()}
    known = {*listed, ("z", "", "block")}
    for i, url in enumerate(urls):
        host, _, path = url[7:].partition("/")
        path = url[7 + len(host) :]
        ends = host.split(".")
        over = {".".join(ends[n:]) for n in range(len(ends))}
        fits = [(len(h + p), -len(h), v, h + p) for h, p, v in known if h in over and path.startswith(p)]
        best = min(fits, key=lambda f: (-f[0], -f[1], f[2]), default=None)
        assert got[i] == ((best[3], best[2]) if best else (None, "allow")), url


def test_rules_do_not_pass_the_driver(spark):
    """A million rules: the driver collects the ends of the ranges only."""
    n = 1_000_000
    rules = spark.range(n).selectExpr(
        "concat('h', id, '.example.com') as host", "'/' as path", "'block' as verdict"
    )
    pages = spark.range(0, n, 997).selectExpr("id as page_id", "concat('http://x.h', id, '.example.com/') as url")
    got = url_filter.match_rules(pages, rules)
    assert got.filter("rule = concat(substring(host, 3), '/') and verdict = 'block'").count() == pages.count()
