"""Joins that hold for any distribution of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlab.sources.stages import broadcast_if_small

#: Parts to which the rows of each key are dealt, always: no size decides it.
SALTS = 16
_ATOMIC = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def _salt(df: DataFrame, salts: int) -> Column:
    """A part that depends on the row's values only, so a repeated task deals alike."""
    own = [f.name for f in df.schema.fields if isinstance(f.dataType, _ATOMIC)]
    return F.pmod(F.xxhash64(*own), F.lit(salts)).cast("int")


def salted_join(
    rows: DataFrame, table: DataFrame, key: str | list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` with a table that has one row, or a few, per key.

    The rows of a key, and those without one, are dealt to ``salts`` parts and the table is
    repeated for each, so no task gets all rows of a hot key.
    """
    parts = F.array(*[F.lit(i) for i in range(salts)])
    dealt = rows.withColumn("_salt", _salt(rows, salts))
    on = [key] if isinstance(key, str) else key
    return dealt.join(table.withColumn("_salt", F.explode(parts)), [*on, "_salt"], how).drop("_salt")


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str | list[str], max_rows: int, how: str = "left"
) -> DataFrame:
    """As ``salted_join``; a table counted to have at most ``max_rows`` rows is broadcast."""
    small = broadcast_if_small(table, max_rows)
    return rows.join(small, key, how) if small is not table else salted_join(rows, table, key, how)
