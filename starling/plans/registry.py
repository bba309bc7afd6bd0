"""Registry of runnable queries: a Spark function and, where SQL can say it, DuckDB text."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register `fn(spark, sf_dir)` under `name`."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # Every timestamp here is UTC; a session in another zone would shift the text.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def stamp(column: str | Column) -> Column:
    """A timestamp as text with microseconds, the same in both engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def duck_stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def big(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")
