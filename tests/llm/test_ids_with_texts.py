"""Rows that share an id but not the text, and rows that repeat both."""

import random

from reviewlab.llm import decontaminate, near_dedup

SCHEMA = "doc_id long, text string, stamp string, id string, head string, gone string, digest string"


def table(spark, rows):
    """Rows with further columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t in rows], SCHEMA)


def shingles(text, size):
    words = (text or "").lower().split()
    k = min(size, len(words))
    return frozenset(tuple(words[a : a + k]) for a in range(len(words) - k + 1)) if words else frozenset()


def brute(rows, size=5, percent=80):
    """Component of every row, and the rows one of each group may stay of."""
    sets = [shingles(t, size) for _, t in rows]
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    least = {}
    for p, (i, _) in zip(part, rows):
        if i is not None:
            least[p] = min(i, least.get(p, i))
    return part, [least.get(p) if i is not None else None for p, (i, _) in zip(part, rows)]


def changed(text, n, word):
    words = text.split()
    return " ".join([*words[:n], word, *words[n + 1 :]])


def body(name, n=200):
    return " ".join(f"{name}{i}" for i in range(n))


def test_every_text_of_an_id_keeps_its_links(spark):
    rows = [
        (1, body("a")), (1, body("b")), (2, changed(body("a"), 9, "x")), (3, changed(body("b"), 9, "x")),
        (5, body("a")), (5, body("c")), (6, body("c")), (6, changed(body("c"), 4, "y")),
        (7, body("d")), (7, body("d")), (7, body("d")), (8, body("e")), (8, changed(body("e"), 3, "z")),
        (9, None), (9, " "), (9, body("f")), (None, body("a")), (None, body("a")), (10, "one"), (11, "one"),
    ]
    docs = table(spark, rows)
    part, component = brute(rows)
    got = near_dedup.near_duplicates(docs).collect()
    want = [(i, len(shingles(t, 5)), c) for (i, t), c in zip(rows, component)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)

    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    stay = [r for r in kept if r[0] is None or not shingles(r[1], 5)]
    assert sorted(stay, key=repr) == sorted(
        [r for r in rows if r[0] is None or not shingles(r[1], 5)], key=repr
    )
    named = [r for r in kept if r[0] is not None and shingles(r[1], 5)]
    of = {r: p for r, p in zip(rows, part) if r[0] is not None and shingles(r[1], 5)}
    # One row of every group, with the smallest id of the group.
    assert sorted(of[r] for r in named) == sorted(set(of.values()))
    assert {of[r]: r[0] for r in named} == {
        of[r]: c for r, c in zip(rows, component) if r in of
    }


def test_random_ids_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SPLIT_PAIRS", 2)
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = rng.choices([f"w{i}" for i in range(300)], k=rng.randint(3, 120))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(base)
            rows.append((rng.randrange(40), " ".join(copy)))
    part, component = brute(rows)
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    want = [(i, len(shingles(t, 5)), c) for (i, t), c in zip(rows, component)]
    assert sorted(map(tuple, got)) == sorted(want)
    kept = near_dedup.keep_first(table(spark, rows)).collect()
    assert len(kept) == len(set(part))


def test_only_contaminated_texts_of_an_id_go(spark):
    item = body("item", 20)
    rows = [(5, item), (5, body("clean")), (5, None), (None, item), (None, body("clean")), (6, item), (6, item)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.drop_contaminated(table(spark, rows), items)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(5, body("clean")), (5, None), (None, body("clean"))], key=repr
    )
