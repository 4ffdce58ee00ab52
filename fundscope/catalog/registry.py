"""Registration of queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        ship(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its name, with the SQL for the same rows."""

    def add(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[key] = sql
        return f

    return add
