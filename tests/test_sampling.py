import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import sampling
from reviewlab.operators.joins import lookup_join, salted_join
from reviewlab.operators.rowids import with_row_id


def labelled(spark, counts, partitions=4):
    data, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            data.append((i, label))
            i += 1
    return spark.createDataFrame(data, "id bigint, sentiment string").repartition(partitions)


def order(seed, key):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:15], 16), key


def per_label(df):
    return Counter(r.sentiment for r in df.collect())


@pytest.mark.parametrize(
    "counts,n,expected",
    [
        ({"Positive": 299, "Neutral": 49, "Negative": 51}, 100,
         {"Positive": 75, "Neutral": 12, "Negative": 13}),
        ({"Positive": 997, "Neutral": 2, "Negative": 1}, 10, None),
        ({"Positive": 1, "Neutral": 1, "Negative": 1}, 2, {"Positive": 1, "Neutral": 1}),
        ({"Positive": 2, "Neutral": 3}, 9, {"Positive": 2, "Neutral": 3}),
    ],
)
def test_quota_sample(spark, counts, n, expected):
    got = per_label(sampling.quota_sample(labelled(spark, counts), n, "id"))
    if expected is None:
        # Rounded quotas 10, 1 (at least) and 1 are repaired by one each, in label order.
        expected = {"Positive": 10}
    assert dict(got) == expected


def test_refill_gives_exactly_n(spark):
    df = labelled(spark, {"Positive": 997, "Neutral": 2, "Negative": 1})
    assert sampling.quota_sample(df, 10, "id", refill=True).count() == 10


def test_selection_is_the_smallest_hashes_whatever_the_partitions(spark):
    counts = {"Positive": 300, "Neutral": 40, "Negative": 60}
    wanted = None
    for parts in (1, 4, 16):
        df = labelled(spark, counts, parts)
        got = {r.id for r in sampling.stratified_subset(df, 100, "id", seed=7).collect()}
        assert len(got) == 100
        wanted = wanted or got
        assert got == wanted
    ids = {"Positive": range(300), "Neutral": range(300, 340), "Negative": range(340, 400)}
    sizes = {"Positive": 75, "Neutral": 10, "Negative": 15}
    brute = set()
    for label, keys in ids.items():
        brute |= set(sorted(keys, key=lambda k: order(7, k))[: sizes[label]])
    assert wanted == brute


def test_infeasible_strata_fall_back_to_all_rows(spark):
    df = labelled(spark, {"Positive": 50, "Neutral": 1})
    got = {r.id for r in sampling.stratified_subset(df, 10, "id").collect()}
    assert got == set(sorted(range(51), key=lambda k: order(42, k))[:10])
    assert got == {r.id for r in sampling.sample_n(df, 10, "id").collect()}
    with pytest.raises(ValueError):
        sampling.stratified_subset(df, 0, "id")
    assert sampling.stratified_subset(df, 60, "id").count() == 51


def test_split_and_folds(spark):
    counts = {"Positive": 101, "Neutral": 23, "Negative": 1}
    df = labelled(spark, counts)
    parted = sampling.stratified_split(df, "id")
    train = per_label(parted.filter("split = 'train'"))
    assert sum(train.values()) == int(125 * 0.7)
    assert all(abs(train[c] - 0.7 * n) < 1 for c, n in counts.items())
    folded = sampling.stratified_folds(df, 5, "id").collect()
    assert len(folded) == 125
    for label in counts:
        sizes = Counter(r.fold for r in folded if r.sentiment == label)
        full = [sizes.get(f, 0) for f in range(5)]
        assert max(full) - min(full) <= 1
    with pytest.raises(ValueError):
        sampling.stratified_folds(df, 1, "id")


def test_group_split_with_a_hot_and_a_null_group(spark):
    data = [(i, "hot" if i % 3 == 0 else f"g{i % 37}", ["Positive", "Negative"][i % 2])
            for i in range(600)]
    data += [(1000 + i, None, "Neutral") for i in range(10)]
    df = spark.createDataFrame(data, "id bigint, asin string, sentiment string")
    parted = sampling.group_stratified_split(df, "asin")
    rows = parted.collect()
    assert len(rows) == 600
    sides = {}
    for r in rows:
        sides.setdefault(r.asin, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert Counter(min(s) for s in sides.values())["train"] == int(len(sides) * 0.7)
    kept = sampling.group_stratified_split(df, "asin", drop_null_group=False)
    assert kept.count() == 610
    assert kept.filter("asin is null").select("split").distinct().count() == 1
    report = {r.key_name: r.shared_keys for r in sampling.split_leakage(parted, ["asin", "id"]).collect()}
    assert report == {"asin": 0, "id": 0}


def test_leakage(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "u string")
    right = spark.createDataFrame([("b",), ("b",), ("c",), (None,)], "u string")
    report = sampling.leakage_report(left, right, ["u"])
    assert tuple(report.first()) == ("u", 2, 2, 1)
    with pytest.warns(UserWarning, match="share 1 values of u"):
        sampling.warn_on_leakage(report)
    assert [r.u for r in sampling.shared_keys(left, right, "u").collect()] == ["b"]
    inside, outside = sampling.split_by_keys(right, left, "u")
    assert (inside.count(), outside.count()) == (2, 2)


@pytest.mark.parametrize("hot", [None, 4])
def test_joins_hold_for_a_hot_unselected_key(spark, hot):
    """Nine rows in ten share a key that is not in the table, or have none."""
    rows = [(i, i % 3 if i % 10 == 0 else hot) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, g int").repartition(3)
    table = spark.createDataFrame([(0, "x"), (1, "y"), (9, "z")], "g int, s string")
    joined = salted_join(df, table, "g")
    assert {(r.id, r.s) for r in joined.collect()} == {
        (i, {0: "x", 1: "y"}.get(g)) for i, g in rows
    }
    # No task of the join gets more than a fair share of the hot key's rows.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dealt = salted_join(df, table.hint("merge"), "g").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in dealt.collect()) < 1300
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    inside, outside = sampling.split_by_keys(df, table, "g")
    assert {r.id for r in inside.collect()} == {i for i, g in rows if g in (0, 1)}
    assert {r.id for r in outside.collect()} == {i for i, g in rows if g not in (0, 1)}


@pytest.mark.parametrize("small", [0, 100])
def test_lookup_joins_agree(spark, small):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(40)], "id int, w string")
    table = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "w string, x double")
    got = lookup_join(df, table, "w", small).collect()
    assert {(r.id, r.x) for r in got} == {(i, 1.0 if i % 3 else None) for i in range(40)}


def test_order(spark):
    df = labelled(spark, {"Positive": 30}, 5)
    ids = [r.id for r in sampling.seeded_shuffle(df, "id", 3).collect()]
    assert ids == sorted(range(30), key=lambda k: order(3, k))
    assert [r.id for r in sampling.first_n(df, 3, "id").collect()] == [0, 1, 2]
    numbered = with_row_id(df.withColumn("x", -F.col("id")), ["x"])
    assert all(r.row_id == 29 - r.id for r in numbered.collect())
    assert numbered.count() == 30


@pytest.mark.parametrize("small", [100_000, 10])
def test_any_number_of_strata(spark, monkeypatch, small):
    """5,000 strata, ranked and joined as few or as many: the same exact draws."""
    monkeypatch.setattr(sampling, "SMALL_STRATA", small)
    rows = [(i, f"s{i % 5000}") for i in range(15_000)]
    df = spark.createDataFrame(rows, "id int, sentiment string")
    split = sampling.stratified_split(df, "id").collect()
    assert len(split) == 15_000 and sum(r.split == "train" for r in split) == 10_500
    per = Counter(r.sentiment for r in split if r.split == "train")
    assert len(per) == 5000 and set(per.values()) == {2, 3}
    # The odd rows go to the first strata in order: all shares are alike.
    assert {s for s, n in per.items() if n == 3} == set(sorted(f"s{i}" for i in range(5000))[:500])
    folds = Counter((r.sentiment, r.fold) for r in sampling.stratified_folds(df, 3, "id").collect())
    assert len(folds) == 15_000
