"""The list of queries, filled by the modules beside this one."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with equivalent SQL where SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = dedent(sql).strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
