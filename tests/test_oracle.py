"""Every registered query with SQL gives the SQL's rows, and all the others run."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(value, 9) + 0.0 if isinstance(value, float) else value


def _rows(names, rows):
    at = [names.index(c) for c in sorted(names)]
    return sorted((tuple(_normal(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    relation = duck.sql(entry.oracle_sql()[name])
    declared = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == declared
    assert _rows(df.columns, df.collect()) == _rows(relation.columns, relation.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
