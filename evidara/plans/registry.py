"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables, read on first use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name`` with its check SQL."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, path: f(Tables(spark, path))
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return f

    return add
