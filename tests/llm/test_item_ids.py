"""Benchmark items whose ids are null or stand for several texts, against the query's SQL."""

import duckdb
import pytest

from reviewlab.llm import decontaminate, queries


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


ITEMS = [
    (None, words("null", 15)),
    (None, words("void", 20)),
    (7, words("question", 15)),
    (7, words("answer", 18)),
    (7, words("answer", 18)),
    (8, "three short words"),
]
DOCS = [
    (1, words("null", 15)),
    (2, "before " + words("question", 15) + " after"),
    (3, words("answer", 18) + " " + words("void", 20)),
    (4, words("question", 15) + " " + words("answer", 18) + " three short words"),
    (5, words("null", 15) + " and " + words("void", 14) + words(" other", 900)),
    (6, words("null", 7) + " " + words("void", 7)),
    (7, None),
    (None, words("void", 20)),
]


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_null_and_repeated_item_ids_equal_sql(spark, tables):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet/*.parquet'")
    df = queries.RUNS["op7_decontaminate"](spark, tables)
    relation = con.sql(queries.SQL["op7_decontaminate"])
    at = [relation.columns.index(c) for c in df.columns]
    want = sorted(([r[i] for i in at] for r in relation.fetchall()), key=repr)
    got = sorted((list(r) for r in df.collect()), key=repr)
    assert got == want
    assert {r[0]: (r[2], r[3]) for r in got if r[0] in (1, 2, 3)} == {1: (15, 1), 2: (15, 1), 3: (38, 2)}


def test_passages_of_such_items_go(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, items).collect()
    assert {r.doc_id for r in left} == {5, 6, 7}
