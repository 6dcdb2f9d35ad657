"""URL rules by a sort-merge range join.

A host written from its last label to its first (``com.example.www.``) begins with the
host of every rule that fits it, so a rule's hosts are one interval of sorted keys, and the
intervals nest. Addresses are stored in ranges of that key; a rule goes to every range its
interval meets: the one it begins in, and those its subdomains reach into. Each range is then
swept once in sorted order, rules before addresses, with a stack of the rules whose intervals
are open. Of the open rules whose path begins the address's path, the longest decides.

The driver holds the ends of the ranges, one pair for each shuffle partition, and no rule. A
range begins under one chain of nested hosts, so all ranges together hold each rule once more
only for each range it is open at the start of. The addresses of a hot host are several ranges.

Edge cases: a null address, or one without ``://``, has an empty host and path and gets no
rule; repeated rows are each judged; other columns are ignored; a rule without host or verdict
is left out, and a null path is an empty one; of rules that fit equally long the one of the
shorter host decides, then the smaller verdict; without rules every address gets the default
verdict; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlab.llm.common import fields, map_rows
from reviewlab.sources.stages import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_key(host: Column) -> Column:
    """Labels from last to first, each closed by a dot: subdomains share the key's start."""
    labels = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(host != "", labels).otherwise("")


def _place(ends: list[tuple[str, str, int]]):
    """Deal rules to the ranges they meet. ``ends``: sorted ``(first key, last key, range)``."""
    firsts, lasts, names = zip(*ends) if ends else ((), (), ())

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for columns in batches:
            rows, ranges = [], []
            for row, key in enumerate(columns["key"].to_pylist()):
                at = bisect_left(lasts, key)
                while at < len(ends) and (firsts[at] <= key or firsts[at].startswith(key)):
                    rows.append(row)
                    ranges.append(names[at])
                    at += 1
            taken = pa.array(rows, pa.int64())
            yield {**{n: c.take(taken) for n, c in columns.items()}, "range": ranges}

    return work


def _sweep(batches: Iterator[dict]) -> Iterator[dict]:
    """Judge the addresses of sorted ranges, in which the rules of a key precede its addresses."""
    stack, place = [], None
    for columns in batches:
        pages, found, verdicts = [], [], []
        names = ("range", "key", "is_page", "path", "rule", "verdict")
        rows = zip(*(columns[n].to_pylist() for n in names))
        for row, (at, key, is_page, path, rule, verdict) in enumerate(rows):
            if (at, key) != place:
                if place and at != place[0]:
                    stack.clear()
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                place = at, key
            if not is_page:
                stack.append((key, path, rule, verdict))
                continue
            best = None
            for open_ in stack:
                if path.startswith(open_[1]) and (best is None or len(open_[2]) > len(best[2])):
                    best = open_
            pages.append(row)
            found.append(best and best[2])
            verdicts.append(best and best[3])
        taken = pa.array(pages, pa.int64())
        yield {
            **{n: columns[n].take(taken) for n in ("id", "host", "path")},
            "rule": found,
            "verdict": verdicts,
        }


def match_rules(
    df: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every address. ``rules``: ``(host, path, verdict)``,
    any number of them."""
    spark = df.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pages = df.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    ).withColumn("key", reversed_key(F.col("host")))
    spread = F.pmod(F.xxhash64("path", "id"), F.lit(1 << 20))
    pages = pages.repartitionByRange(shards, "key", spread)
    pages = materialize(pages.withColumn("range", F.spark_partition_id()), "ranges")
    ends = pages.groupBy("range").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    ends = sorted((r["first"], r["last"], r["range"]) for r in ends.collect())

    path = F.coalesce("path", F.lit(""))
    host = F.translate("host", UPPER, LOWER)
    listed = rules.filter("verdict is not null and host <> ''").select(
        reversed_key(host).alias("key"), path.alias("path"), F.concat(host, path).alias("rule"),
        "verdict",
    )
    schema = T.StructType(
        [*fields(listed, *listed.columns), T.StructField("range", T.IntegerType())]
    )
    dealt = map_rows(listed.distinct(), _place(ends), schema).withColumn("is_page", F.lit(False))
    rows = pages.withColumn("is_page", F.lit(True)).unionByName(dealt, allowMissingColumns=True)
    order = ["range", "key", "is_page", F.when(~F.col("is_page"), F.col("path")), "verdict"]
    rows = rows.repartitionById(shards, "range").sortWithinPartitions(*order)
    schema = T.StructType(fields(rows, "id", "host", "path", "rule", "verdict"))
    return map_rows(rows, _sweep, schema).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
