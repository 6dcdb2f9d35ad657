"""The registered queries: a Spark function each, and SQL stating the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewlab.session import configure

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with its SQL unless SQL cannot state it."""

    def add(run: Run) -> Run:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        configured.__name__ = run.__name__
        configured.__doc__ = run.__doc__
        RUNS[run.__name__] = configured
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return add
