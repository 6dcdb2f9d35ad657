"""Sampling queries: samples, splits, folds, overlap of keys, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import profile, sampling
from reviewlab.operators.rowids import with_row_id
from reviewlab.operators.smote import as_points, class_neighbours, class_sizes
from reviewlab.operators.smote import smote as oversample
from reviewlab.plans import prepare
from reviewlab.queries import texts, views as v
from reviewlab.queries.registry import query
from reviewlab.sources.stages import materialize

_RANKED_SQL = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment
  ORDER BY {v.hash_sql('review_id')}, review_id) AS rn FROM base)"""
_COUNTS_SQL = """c AS (SELECT sentiment, count(*) AS rows, sum(count(*)) OVER () AS total
  FROM base GROUP BY sentiment)"""


def _remainder_sql(want: str, counts: str = "c", name: str = "q") -> str:
    """Proportional whole numbers adding up to ``want``, leftovers to the largest rests."""
    return f"""w AS (SELECT *, CAST({want} AS HUGEINT) AS want FROM {counts}),
f AS (SELECT *, (want * rows) // total AS fl, (want * rows) % total AS rest FROM w),
{name} AS (SELECT sentiment, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, sentiment)
  <= want - sum(fl) OVER () THEN 1 ELSE 0 END AS k FROM f)"""


@query(f"""{v.with_views(v.LABELED_DOCS)}, base AS (SELECT * FROM labeled_docs),
{_COUNTS_SQL}, {_RANKED_SQL},
a AS (SELECT *, greatest(1, CAST(round_even(100 * rows / total, 0) AS BIGINT)) AS quota FROM c),
g AS (SELECT *, 100 - sum(quota) OVER () AS gap, row_number() OVER (ORDER BY sentiment) AS place
      FROM a),
q AS (SELECT sentiment, least(rows, quota + CASE WHEN place <= abs(gap) THEN sign(gap) ELSE 0 END)
        AS k FROM g)
SELECT review_id, ranked.sentiment, overall FROM ranked JOIN q USING (sentiment) WHERE rn <= k""")
def quota_sample(spark, sf):
    df = sampling.quota_sample(v.labeled_docs(spark, sf), 100, "review_id")
    return df.select("review_id", "sentiment", "overall")


@query(f"""{v.with_views(v.REVIEWS)}, base AS (SELECT * FROM reviews),
{_COUNTS_SQL}, {_RANKED_SQL}, {_remainder_sql('least(2000, total)')}
SELECT review_id, ranked.sentiment, overall FROM ranked JOIN q USING (sentiment) WHERE rn <= k""")
def stratified_subset(spark, sf):
    df = sampling.stratified_subset(v.labelled_reviews(spark, sf), 2000, "review_id")
    return df.select("review_id", "sentiment", "overall")


@query(f"""{v.with_views(v.LABELED_DOCS, texts.RAW_SQL)},
{texts.PREPARED_SQL}, base AS (SELECT review_id, sentiment, overall FROM prepared),
{_COUNTS_SQL}, {_RANKED_SQL}, {_remainder_sql('least(200, total)')},
subset AS (SELECT ranked.* FROM ranked JOIN q USING (sentiment) WHERE rn <= k)
SELECT 'rows_loaded' AS measure, NULL AS value, count(*) AS n FROM raw
UNION ALL SELECT 'rows_labelled', NULL, count({v.label_sql('stars')}) FROM parsed
UNION ALL SELECT 'rows_with_text', NULL, count(*) FROM prepared
UNION ALL SELECT 'subset_rows', NULL, count(*) FROM subset
UNION ALL SELECT 'sentiment', sentiment, count(*) FROM subset GROUP BY 2
UNION ALL SELECT 'rating', CAST(overall AS VARCHAR), count(*) FROM subset GROUP BY 2""")
def subset_report(spark, sf):
    """What the steps from raw rows to a subset left; the first counts come from the job that
    stores the prepared rows."""
    counts = prepare.RunCounts()
    prepared = materialize(prepare.prepare_reviews(texts.raw_reviews(spark, sf), counts=counts))
    subset = sampling.stratified_subset(prepared, 200, "review_id")
    return profile.subset_report(subset, counts.get())


@query(f"""{v.with_views(v.REVIEWS)}
SELECT review_id, asin FROM reviews ORDER BY {v.hash_sql('review_id')}, review_id LIMIT 1000""")
def sample_n(spark, sf):
    return sampling.sample_n(v.reviews(spark, sf), 1000, "review_id").select("review_id", "asin")


_SPLIT_WANT = "floor(total * 0.7e0 + 1e-9)"


@query(f"""{v.with_views(v.REVIEWS)}, base AS (SELECT * FROM reviews),
{_COUNTS_SQL}, {_RANKED_SQL}, {_remainder_sql(_SPLIT_WANT)}
SELECT review_id, ranked.sentiment, CASE WHEN rn <= k THEN 'train' ELSE 'test' END AS split
FROM ranked JOIN q USING (sentiment)""")
def row_split(spark, sf):
    df = sampling.stratified_split(v.labelled_reviews(spark, sf), "review_id")
    return df.select("review_id", "sentiment", "split")


_GROUP_SPLIT_SQL = f"""k AS (SELECT "reviewerID", sentiment, count(*) AS n FROM reviews GROUP BY 1, 2),
m AS (SELECT *, row_number() OVER (PARTITION BY "reviewerID" ORDER BY n DESC, sentiment) AS rn
      FROM k),
base AS (SELECT "reviewerID", sentiment FROM m WHERE rn = 1),
{_COUNTS_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment
  ORDER BY {v.hash_sql('"reviewerID"')}, "reviewerID") AS rn FROM base),
{_remainder_sql(_SPLIT_WANT)},
parted AS (SELECT "reviewerID", CASE WHEN rn <= k THEN 'train' ELSE 'test' END AS split
           FROM ranked JOIN q USING (sentiment)),
divided AS (SELECT reviews.*, split FROM reviews JOIN parted USING ("reviewerID"))"""


@query(f"""{v.with_views(v.REVIEWS)}, {_GROUP_SPLIT_SQL}
SELECT review_id, "reviewerID", split FROM divided""")
def group_split(spark, sf):
    df = sampling.group_stratified_split(v.labelled_reviews(spark, sf), "reviewerID")
    return df.select("review_id", "reviewerID", "split")


@query(f"""{v.with_views(v.REVIEWS)}
SELECT review_id, sentiment, CAST(ntile(5) OVER (PARTITION BY sentiment
  ORDER BY {v.hash_sql('review_id')}, review_id) - 1 AS INTEGER) AS fold FROM reviews""")
def folds(spark, sf):
    df = sampling.stratified_folds(v.labelled_reviews(spark, sf), 5, "review_id")
    return df.select("review_id", "sentiment", "fold")


def _leakage_sql(key: str) -> str:
    name = key.strip('"')
    return f"""SELECT '{name}' AS key_name,
  (SELECT count(DISTINCT {key}) FROM divided WHERE split = 'train') AS train_keys,
  (SELECT count(DISTINCT {key}) FROM divided WHERE split = 'test') AS test_keys,
  (SELECT count(*) FROM (SELECT {key} FROM divided WHERE split = 'train' INTERSECT
     SELECT {key} FROM divided WHERE split = 'test')) AS shared_keys"""


@query(f"""{v.with_views(v.REVIEWS)}, {_GROUP_SPLIT_SQL}
{' UNION ALL '.join(_leakage_sql(k) for k in ('"reviewerID"', 'asin', 'review_id'))}""")
def leakage_report(spark, sf):
    df = sampling.group_stratified_split(v.labelled_reviews(spark, sf), "reviewerID")
    return sampling.split_leakage(df, ["reviewerID", "asin", "review_id"])


@query(f"""{v.with_views(v.REVIEWS)}
SELECT asin FROM reviews WHERE verified INTERSECT SELECT asin FROM reviews WHERE NOT verified""")
def shared_products(spark, sf):
    df = v.reviews(spark, sf)
    return sampling.shared_keys(df.filter("verified"), df.filter("not verified"), "asin")


@query(f"""{v.with_views(v.REVIEWS)},
a AS (SELECT * FROM reviews WHERE verified), b AS (SELECT * FROM reviews WHERE NOT verified)
SELECT k AS key_name, CAST(t AS BIGINT) AS train_keys, CAST(u AS BIGINT) AS test_keys,
       CAST(s AS BIGINT) AS shared_keys FROM (VALUES
  ('asin', (SELECT count(DISTINCT asin) FROM a), (SELECT count(DISTINCT asin) FROM b),
   (SELECT count(*) FROM (SELECT asin FROM a INTERSECT SELECT asin FROM b))),
  ('reviewerID', (SELECT count(DISTINCT "reviewerID") FROM a),
   (SELECT count(DISTINCT "reviewerID") FROM b),
   (SELECT count(*) FROM (SELECT "reviewerID" FROM a INTERSECT SELECT "reviewerID" FROM b))))
  x(k, t, u, s)""")
def overlap_of_sets(spark, sf):
    df = v.reviews(spark, sf)
    return sampling.leakage_report(
        df.filter("verified"), df.filter("not verified"), ["asin", "reviewerID"]
    )


@query(f"""{v.with_views(v.REVIEWS)}, hit AS (SELECT DISTINCT asin FROM reviews WHERE verified)
SELECT review_id, asin IN (SELECT asin FROM hit) AS selected FROM reviews""")
def split_by_keys(spark, sf):
    df = v.reviews(spark, sf)
    inside, outside = sampling.split_by_keys(df, df.filter("verified"), "asin")
    return (
        inside.select("review_id")
        .withColumn("selected", F.lit(True))
        .unionByName(outside.select("review_id").withColumn("selected", F.lit(False)))
    )


@query(f"""{v.with_views(v.REVIEWS)}
SELECT review_id, row_number() OVER (ORDER BY "unixReviewTime", review_id) - 1 AS row_id
FROM reviews""")
def row_ids(spark, sf):
    df = v.reviews(spark, sf).select("review_id", "unixReviewTime")
    return with_row_id(df, ["unixReviewTime", "review_id"]).select("review_id", "row_id")


@query(f"""{v.with_views(v.REVIEWS)}
SELECT review_id, reviewers.k AS selected FROM (
  SELECT review_id, row_number() OVER (ORDER BY {v.hash_sql('review_id')}, review_id) AS k
  FROM reviews) reviewers ORDER BY k LIMIT 50""")
def shuffled_head(spark, sf):
    ordered = sampling.seeded_shuffle(v.reviews(spark, sf), "review_id").limit(50)
    return with_row_id(
        ordered.withColumn("_h", sampling.seeded_hash("review_id", 42)), ["_h", "review_id"]
    ).select("review_id", (F.col("row_id") + 1).alias("selected"))


@query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (SELECT a.vec_id, list_sum(list_transform(list_zip(a.x, b.x),
            lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY d) AS INTEGER) AS rank, d
      FROM pairs)
SELECT vec_id, rank, round(d, 3) AS squared_distance FROM r WHERE rank <= 5""")
def nearest_neighbours(spark, sf):
    """The five nearest rows of the same class of every row."""
    df = v.table(spark, sf, "embeddings")
    points = as_points(df, "label", "vec_id", "embedding")
    near = class_neighbours(points, points, class_sizes(df, "label"), 5, block_rows=16_384)
    return near.select(
        F.col("_q").cast("bigint").alias("vec_id"),
        F.col("_rank").alias("rank"),
        F.round("_d", 3).alias("squared_distance"),
    )


@query("""WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT CAST(label AS VARCHAR) AS label, max(n) OVER () AS n, max(n) OVER () - n AS synthetic
FROM c""")
def smote_counts(spark, sf):
    """Rows per class after oversampling, and how many of them are synthetic."""
    df = v.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    raised = oversample(df, "label", "vec_id", "embedding")
    return raised.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("synthetic")
    )


@query()
def smote(spark, sf):
    df = v.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return oversample(df, "label", "vec_id", "embedding")


_SMOTE_SQL = f"""
WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS label,
             CAST(embedding AS DOUBLE[]) AS x, {v.hash_sql('vec_id')} AS h
           FROM embeddings WHERE label IS NOT NULL),
c AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS most,
        CASE WHEN min(count(*)) OVER () > 6 THEN 5 ELSE min(count(*)) OVER () - 1 END AS k
      FROM e GROUP BY label),
bases AS (SELECT e.*, n, k, (most - n) // n + CAST(row_number() OVER (
            PARTITION BY label ORDER BY h, id) <= (most - n) % n AS INTEGER) AS turns
          FROM e JOIN c USING (label) WHERE n < most),
pairs AS (SELECT a.label, a.id AS q, b.id AS nb, a.turns, a.x AS x, b.x AS y,
            least(a.k, a.n - 1) AS k, a.h AS h, row_number() OVER (PARTITION BY a.id ORDER BY
              list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS rank
          FROM bases a JOIN e b ON a.label = b.label AND a.id <> b.id),
shares AS (SELECT *, ((rank - 1 - h % k) % k + k) % k AS first FROM pairs WHERE rank <= k),
made AS (SELECT *, unnest(range(CASE WHEN turns > first THEN (turns - 1 - first) // k + 1 ELSE 0 END)) AS number
         FROM shares),
named AS (SELECT *, q || '/' || rank || '/' || number AS row_id FROM made),
drawn AS (SELECT *, ({v.hash_sql('row_id')} >> 8) / CAST(4503599627370496 AS DOUBLE) AS u
          FROM (SELECT label, q, nb, x, y, row_id FROM named) AS s)
SELECT row_id, label, q AS base_id, nb AS neighbour_id,
  round(list_sum(list_transform(list_zip(x, y), lambda p: p[1] + u * (p[2] - p[1]))), 3) AS total
FROM drawn"""


@query(_SMOTE_SQL)
def smote_rows(spark, sf):
    """Every synthetic row with its base, its neighbour and the sum of its components."""
    made = smote(spark, sf).filter("synthetic")
    total = F.aggregate(
        F.col("embedding").cast("array<double>"), F.lit(0.0).cast("double"), lambda a, x: a + x
    )
    return made.select(
        F.col("vec_id").alias("row_id"),
        "label",
        "base_id",
        "neighbour_id",
        F.round(total, 3).alias("total"),
    )
