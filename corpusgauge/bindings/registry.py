"""Named queries over the given tables, each beside its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """Attribute access to the parquet tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` or its own name, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[key] = sql
        return fn

    return register
