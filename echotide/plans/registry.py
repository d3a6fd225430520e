"""The list of queries, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name if none is given, with the SQL it must agree
    with."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its read splits spread the work."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: str | Column) -> Column:
    """A date as ISO text."""
    return F.date_format(c, "yyyy-MM-dd")
