"""Order-dependent operators: first and best of a group, carry-forward, pairing, look-around."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key; NULL components are values of their own."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def best_and_drops(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Rows with ``is_best`` and the group's size: all others of the group are drops."""
    w = Window.partitionBy(*keys)
    return df.withColumns({"is_best": F.row_number().over(w.orderBy(*order)) == 1, "group_size": F.count(F.lit(1)).over(w)})


def carried(value: Column, by: Sequence[str | Column], order: Sequence[Column]) -> Column:
    """The last value that isn't NULL, up to the row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def next_rows(value: Column, by: Sequence[str | Column], order: Sequence[Column], most: int) -> Column:
    """Values of the up to ``most`` rows that follow, in order."""
    return F.collect_list(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(1, most))


def around(value: Column, by: Sequence[str | Column], order: Sequence[Column], before: int, after: int) -> Column:
    return F.collect_list(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-before, after))


def until(values: Column, stop) -> Column:
    """The values before the first that ``stop`` holds for."""
    state = F.struct(F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(s, x):
        done = s["done"] | F.coalesce(stop(x), F.lit(False))
        return F.struct(done.alias("done"), F.when(done, s["kept"]).otherwise(F.array_append(s["kept"], x)).alias("kept"))

    return F.aggregate(values, state, step, lambda s: s["kept"])


def history(df: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """(key, history, current): years descending, and the latest value that isn't NULL."""
    known = F.struct(F.col(year).alias("year"), F.col(value).alias("value"))
    return df.groupBy(key).agg(F.sort_array(F.collect_list(known), asc=False).alias("history"), F.max_by(value, F.when(F.col(value).isNotNull(), F.col(year))).alias("current"))
