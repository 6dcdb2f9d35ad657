"""Samples, splits and folds that do not depend on partitioning.

Every operator here ranks rows by a seeded hash of their unique key inside a
stratum and cuts the ranking at exact positions. The ranking is never built:
counting rows per hash bucket locates the bucket of each cut, only that bucket's
keys (1 in 16,384) are ordered, and the selection itself is a comparison with the
``(hash, key)`` cut points of the row's stratum. Wide rows are filtered where they are
read; a stratum with most of the rows is no different from the others.

Rows whose stratum is null belong to no stratum and are not drawn. There may be any number
of strata: the cut points, one or a few per stratum, are written once and their count decides
whether they are sent to every task or joined by salted keys.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F, Window

from reviewlab.functions.hashing import hash_bucket, seeded_hash
from reviewlab.operators.joins import lookup_join, salted_join
from reviewlab.operators.profile import majority_label
from reviewlab.operators.rowids import with_row_id
from reviewlab.schema import LABELS, require_columns
from reviewlab.sources.stages import materialize

_ALL = "*"
#: Cut points sent to every task, and strata ranked in one.
SMALL_STRATA = 100_000


def _keyed(df: DataFrame, key: str, stratum: Column, seed: int) -> DataFrame:
    return df.select(
        stratum.cast("string").alias("_stratum"),
        seeded_hash(key, seed).alias("_h"),
        F.col(key).alias("_key"),
    ).filter("_stratum is not null")


def _bucket_counts(keyed: DataFrame) -> DataFrame:
    """``(_stratum, _bucket, _n)``: at most 2^14 rows per stratum, written once because
    quotas and positions are both counted from it."""
    counts = (
        keyed.select("_stratum", hash_bucket("_h").alias("_bucket"))
        .groupBy("_stratum", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return materialize(counts, "buckets")


def _stratum_counts(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy("_stratum").agg(F.sum("_n").alias("_rows"))


def _with_sum(df: DataFrame, col: str, name: str) -> DataFrame:
    """Add the sum of ``col`` over all rows: one row, joined to each."""
    return df.crossJoin(F.broadcast(df.agg(F.sum(col).alias(name))))


def _with_place(df: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    """Add ``_place``, 1 for the first row by ``order`` (column, descending). Few strata are
    ranked in one task, many by a distributed sort."""
    df = materialize(df, "strata")
    if df.count() <= SMALL_STRATA:
        by = [F.desc(c) if down else F.asc(c) for c, down in order]
        return df.withColumn("_place", F.row_number().over(Window.orderBy(*by)))
    flipped = [f"_by{i}" for i in range(len(order))]
    keys = {n: -F.col(c) if down else F.col(c) for n, (c, down) in zip(flipped, order)}
    numbered = with_row_id(df.withColumns(keys), flipped, "_place").drop(*flipped)
    return numbered.withColumn("_place", F.col("_place") + 1)


def _cut_points(keyed: DataFrame, buckets: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets (_stratum, _cut, _k)`` to ``(_stratum, _cut, _at struct<h, key>)``: the hash
    and key of the row of rank ``_k``. Cuts at rank 0 have no row and are left out."""
    w = Window.partitionBy("_stratum").orderBy("_bucket")
    running = buckets.withColumn(
        "_upto", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_before", F.col("_upto") - F.col("_n"))
    located = (
        running.join(targets, "_stratum")
        .filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_upto")))
        .select("_stratum", "_cut", "_bucket", (F.col("_k") - F.col("_before")).alias("_rank"))
    )
    # One row per stratum and cut. Only keys of the buckets that are cut get ordered.
    inside = Window.partitionBy("_stratum", "_cut").orderBy("_h", "_key")
    located = materialize(located, "located-cuts")
    placed = keyed.withColumn("_bucket", hash_bucket("_h"))
    cuts = (
        lookup_join(placed, located, ["_stratum", "_bucket"], SMALL_STRATA, "inner")
        .withColumn("_place", F.row_number().over(inside))
        .filter("_place = _rank")
        .select("_stratum", "_cut", F.struct(F.col("_h"), F.col("_key")).alias("_at"))
    )
    return materialize(cuts, "cuts")


def _with_cut_index(
    df: DataFrame, key: str, stratum: Column, seed: int, cuts: DataFrame, name: str
) -> DataFrame:
    """Add ``name``: how many cut points of its stratum lie before the row."""
    per_stratum = cuts.groupBy("_stratum").agg(F.collect_list("_at").alias("_cuts"))
    at = F.struct(seeded_hash(key, seed).alias("_h"), F.col(key).alias("_key"))
    rows = df.withColumn("_stratum", stratum.cast("string")).filter("_stratum is not null")
    return (
        lookup_join(rows.withColumn("_at", at), per_stratum, "_stratum", SMALL_STRATA)
        .withColumn(
            name,
            F.coalesce(
                F.size(F.filter("_cuts", lambda c: c < F.col("_at"))), F.lit(0)
            ).cast("int"),
        )
        .drop("_stratum", "_at", "_cuts")
    )


def _mark_first(
    df: DataFrame, key: str, stratum: Column, seed: int, cuts: DataFrame, name: str
) -> DataFrame:
    """Add boolean ``name``: whether the row lies at or before its stratum's only cut.
    A stratum without a cut point has quota 0."""
    at = F.struct(seeded_hash(key, seed).alias("_h"), F.col(key).alias("_key"))
    rows = df.withColumn("_stratum", stratum.cast("string")).filter("_stratum is not null")
    return (
        lookup_join(rows, cuts.select("_stratum", "_at"), "_stratum", SMALL_STRATA)
        .withColumn(name, F.coalesce(at <= F.col("_at"), F.lit(False)))
        .drop("_stratum", "_at")
    )


def _take_first(
    df: DataFrame, key: str, stratum: Column, seed: int, keyed: DataFrame, buckets: DataFrame,
    quotas: DataFrame,
) -> DataFrame:
    """Rows of rank up to their stratum's ``_k``."""
    cuts = _cut_points(keyed, buckets, quotas.withColumn("_cut", F.lit(0)))
    at = F.struct(seeded_hash(key, seed).alias("_h"), F.col(key).alias("_key"))
    # An inner join on one row per stratum: strata with quota 0 have no cut point.
    rows = df.withColumn("_stratum", stratum.cast("string"))
    return (
        lookup_join(rows, cuts.select("_stratum", "_at"), "_stratum", SMALL_STRATA, "inner")
        .filter(at <= F.col("_at"))
        .drop("_stratum", "_at")
    )


def quota_cut(
    df: DataFrame, quotas: dict[str, int], key: str, stratum: str, seed: int, name: str
) -> DataFrame:
    """Add boolean ``name``: whether the row is among the first ``quotas[stratum]`` of its
    stratum in hash order."""
    wanted = [(c, 0, int(n)) for c, n in quotas.items() if n > 0]
    if not wanted:
        return df.withColumn(name, F.lit(False))
    keyed = _keyed(df, key, F.col(stratum), seed)
    targets = df.sparkSession.createDataFrame(wanted, "_stratum string, _cut int, _k bigint")
    cuts = _cut_points(keyed, _bucket_counts(keyed), targets)
    return _mark_first(df, key, F.col(stratum), seed, cuts, name)


# --- quotas over the per-stratum counts (one row per stratum) ----------------------


def _rounded_quotas(counts: DataFrame, n: int) -> DataFrame:
    """Half-even rounded shares, at least 1; then each stratum in alphabetical order is
    moved by one until the sum is ``n``, visiting each once; never more than there is."""
    first = _with_sum(counts, "_rows", "_total").withColumn(
        "_q", F.greatest(F.lit(1), F.bround(n * F.col("_rows") / F.col("_total")).cast("bigint"))
    )
    placed = _with_sum(_with_place(first, [("_stratum", False)]), "_q", "_given")
    repaired = placed.withColumn("_gap", F.lit(n) - F.col("_given")).withColumn(
        "_q",
        F.col("_q")
        + F.when(F.col("_place") <= F.abs("_gap"), F.signum("_gap").cast("int")).otherwise(0),
    )
    return repaired.select(
        "_stratum",
        F.when(F.col("_total") <= n, F.col("_rows"))
        .otherwise(F.least("_q", "_rows"))
        .alias("_k"),
    )


def _largest_remainder(counts: DataFrame, n: Column) -> DataFrame:
    """Exactly ``n`` in total, proportional; leftovers to the largest fractions, ties in
    stratum order. Whole-number arithmetic, so no engine rounds differently."""
    share = (
        _with_sum(counts, "_rows", "_total")
        .withColumn("_want", F.least(n, F.col("_total")).cast("bigint"))
        .withColumn("_floor", F.expr("_want * _rows div _total"))
        .withColumn("_rest", F.expr("_want * _rows % _total"))
    )
    placed = _with_place(share, [("_rest", True), ("_stratum", False)])
    placed = _with_sum(placed, "_floor", "_given")
    more = F.col("_place") <= F.col("_want") - F.col("_given")
    return placed.select(
        "_stratum", (F.col("_floor") + F.when(more, F.lit(1)).otherwise(0)).alias("_k")
    )


# --- samples ---------------------------------------------------------------------------


def quota_sample(
    df: DataFrame, n: int, key: str, label: str = "sentiment", seed: int = 42,
    refill: bool = False,
) -> DataFrame:
    """Stratified sample with rounded quotas per label; everything when ``n`` covers it.

    A label with fewer rows than its quota gives what it has; ``refill=True`` allots
    exactly ``n`` rows instead.
    """
    require_columns(df, [label, key])
    stratum = F.col(label)
    keyed = _keyed(df, key, stratum, seed)
    buckets = _bucket_counts(keyed)
    counts = _stratum_counts(buckets)
    quotas = _largest_remainder(counts, F.lit(n)) if refill else _rounded_quotas(counts, n)
    return _take_first(df, key, stratum, seed, keyed, buckets, quotas)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement."""
    stratum = F.lit(_ALL)
    keyed = _keyed(df, key, stratum, seed)
    buckets = _bucket_counts(keyed)
    quotas = _largest_remainder(_stratum_counts(buckets), F.lit(n))
    return _take_first(df, key, stratum, seed, keyed, buckets, quotas)


def stratified_subset(
    df: DataFrame, n: int, key: str, label: str = "sentiment", seed: int = 42
) -> DataFrame:
    """Exactly ``n`` rows, proportional per label.

    When stratifying is not feasible (a label with a single row, or fewer rows than
    labels on either side) the rows are drawn without regard to the label.
    """
    if n <= 0:
        raise ValueError("a subset needs at least one row")
    require_columns(df, [label, key])
    keyed = _keyed(df, key, F.col(label), seed)
    by_label = _bucket_counts(keyed)
    feasible = (
        _stratum_counts(by_label)
        .agg(
            F.min("_rows").alias("_least"),
            F.count(F.lit(1)).alias("_classes"),
            F.sum("_rows").alias("_total"),
        )
        .select(
            (
                (F.col("_least") >= 2)
                & (F.lit(n) >= F.col("_classes"))
                & (F.col("_total") - n >= F.col("_classes"))
            ).alias("_feasible")
        )
    )
    # One row decides between the labels and a single stratum holding every row.
    flag = F.broadcast(feasible)
    pick = F.when(F.col("_feasible"), F.col("_stratum")).otherwise(F.lit(_ALL))
    keyed = keyed.crossJoin(flag).withColumn("_stratum", pick).drop("_feasible")
    buckets = _bucket_counts(keyed)
    quotas = _largest_remainder(_stratum_counts(buckets), F.lit(n))
    rows = df.filter(F.col(label).isNotNull()).crossJoin(flag)
    stratum = F.when(F.col("_feasible"), F.col(label).cast("string")).otherwise(F.lit(_ALL))
    return _take_first(rows, key, stratum, seed, keyed, buckets, quotas).drop("_feasible")


# --- splits ------------------------------------------------------------------------------


def stratified_split(
    df: DataFrame, key: str, label: str = "sentiment", fraction: float = 0.7, seed: int = 42
) -> DataFrame:
    """Add ``split`` (``train`` / ``test``): ``fraction`` of the rows train, per label."""
    require_columns(df, [label, key])
    stratum = F.col(label)
    keyed = _keyed(df, key, stratum, seed)
    buckets = _bucket_counts(keyed)
    counts = _stratum_counts(buckets)
    # floor of the fraction of all rows, held exactly by the allocation.
    want = F.floor(F.col("_total") * F.lit(fraction) + F.lit(1e-9))
    quotas = _largest_remainder(counts, want)
    cuts = _cut_points(keyed, buckets, quotas.withColumn("_cut", F.lit(0)))
    marked = _mark_first(df, key, stratum, seed, cuts, "_train")
    return marked.withColumn("split", F.when(F.col("_train"), "train").otherwise("test")).drop(
        "_train"
    )


def stratified_folds(
    df: DataFrame, k: int, key: str, label: str = "sentiment", seed: int = 42
) -> DataFrame:
    """Add ``fold`` in 0..k-1; fold sizes of a label differ by at most one row."""
    if k < 2:
        raise ValueError("at least 2 folds are needed")
    require_columns(df, [label, key])
    stratum = F.col(label)
    keyed = _keyed(df, key, stratum, seed)
    buckets = _bucket_counts(keyed)
    # Fold f ends at rank f*q + min(f, r): the first r folds hold the extra row.
    targets = (
        _stratum_counts(buckets)
        .select("_stratum", "_rows", F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("_cut"))
        .select(
            "_stratum",
            "_cut",
            (
                F.col("_cut") * F.expr(f"_rows div {k}")
                + F.least(F.col("_cut").cast("bigint"), F.expr(f"_rows % {k}"))
            ).alias("_k"),
        )
    )
    cuts = _cut_points(keyed, buckets, targets.filter("_k > 0"))
    return _with_cut_index(df, key, stratum, seed, cuts, "fold")


def group_stratified_split(
    df: DataFrame, group: str, label: str = "sentiment", fraction: float = 0.7, seed: int = 42,
    labels: list[str] = LABELS, drop_null_group: bool = True,
) -> DataFrame:
    """Add ``split``: groups are divided, stratified by their majority label, and every
    row with one of ``labels`` follows its group; rows with another label are dropped. Rows
    without a group are dropped as well, or form one group.

    The table of groups is read several times, so it is written once.
    """
    require_columns(df, [label, group])
    rows = df.filter(F.col(label).isin(labels))
    if drop_null_group:
        rows = rows.filter(F.col(group).isNotNull())
        table = materialize(majority_label(rows, group, label, labels), "groups")
        assigned = stratified_split(table, group, label, fraction, seed).drop(label)
        return salted_join(rows, assigned.drop("n"), group)
    named = rows.withColumn(
        "_group", F.concat_ws(":", F.lit("g"), F.col(group).cast("string"))
    )
    table = materialize(majority_label(named, "_group", label, labels), "groups")
    assigned = stratified_split(table, "_group", label, fraction, seed).drop(label)
    return salted_join(named, assigned.drop("n"), "_group").drop("_group")


def split_by_keys(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in ``keys``, and the others (a null key is in neither table)."""
    wanted = distinct_keys(keys, key).withColumn("_selected", F.lit(True))
    marked = salted_join(df, wanted, key)
    inside = marked.filter("_selected").drop("_selected")
    return inside, marked.filter("_selected is null").drop("_selected")


# --- keys in two sets -----------------------------------------------------------------


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(key).distinct()


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys found on both sides."""
    return distinct_keys(left, key).intersect(distinct_keys(right, key))


def _tagged_keys(df: DataFrame, keys: list[str], bit: Column) -> DataFrame:
    """``(key_name, key, side)``, one row per key column."""
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("key"))
            for k in keys
        ]
    )
    return df.select(F.inline(pairs), bit.alias("side")).filter("key is not null")


def _overlap(tagged: DataFrame) -> DataFrame:
    seen = tagged.groupBy("key_name", "key").agg(F.bit_or("side").alias("sides"))
    return seen.groupBy("key_name").agg(
        F.count_if(F.col("sides").bitwiseAND(1) != 0).alias("train_keys"),
        F.count_if(F.col("sides").bitwiseAND(2) != 0).alias("test_keys"),
        F.count_if(F.col("sides") == 3).alias("shared_keys"),
    )


def leakage_report(train: DataFrame, test: DataFrame, keys: list[str]) -> DataFrame:
    """``(key_name, train_keys, test_keys, shared_keys)`` for each key column.

    Both sides are tagged and combined into one grouped pass over ``(name, key)``.
    """
    return _overlap(
        _tagged_keys(train, keys, F.lit(1)).unionByName(_tagged_keys(test, keys, F.lit(2)))
    )


def split_leakage(df: DataFrame, keys: list[str], split: str = "split") -> DataFrame:
    """``leakage_report`` for a table that carries its split as a column, in one scan."""
    side = F.when(F.col(split) == "train", 1).otherwise(2)
    return _overlap(_tagged_keys(df, keys, side))


def warn_on_leakage(report: DataFrame) -> None:
    """Warn for each key column that both sides share. Collects one row per column."""
    for row in report.filter("shared_keys > 0").collect():
        warnings.warn(f"train and test share {row.shared_keys} values of {row.key_name}")


# --- order -------------------------------------------------------------------------------


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a random but repeatable order (a range-partitioned sort)."""
    return df.orderBy(seeded_hash(key, seed), key)


def first_n(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows by ``order``; all of them when there are fewer."""
    return df.orderBy(order).limit(n)
