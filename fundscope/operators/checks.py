"""Data quality: checks as rows (section, check, status, detail), duplicate groups, audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank


def status(bad: Column, warn: int = 1, fail: int | None = None) -> Column:
    """PASS below ``warn`` findings, FAIL from ``fail`` on, WARN between."""
    out = F.when(bad < warn, "PASS")
    return out.when(bad >= fail, "FAIL").otherwise("WARN") if fail is not None else out.otherwise("WARN")


def rows(section: str, df: DataFrame, tests: dict[str, tuple[Column, int, int | None]]) -> DataFrame:
    """A check row per test (bad rows, warn from, fail from): one pass over the table."""
    one = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(t).alias(k) for k, (t, _, _) in tests.items()])
    checks = F.array(*[F.struct(F.lit(k).alias("check"), status(F.col(k), warn, fail).alias("status"), F.concat_ws("/", F.col(k).cast("string"), F.col("_total").cast("string")).alias("detail")) for k, (_, warn, fail) in tests.items()])
    return one.select(F.explode(checks).alias("c")).select(F.lit(section).alias("section"), "c.check", "c.status", "c.detail")


def null_rates(section: str, df: DataFrame, columns: list[str], warn: float = 0.2, fail: float = 0.5) -> DataFrame:
    kinds = dict(df.dtypes)
    missing = lambda c: is_blank(F.col(c)) if kinds[c] == "string" else F.col(c).isNull()
    one = df.agg(*[F.try_divide(F.count_if(missing(c)), F.count(F.lit(1))).alias(c) for c in columns])
    long = one.unpivot([], columns, "check", "rate")
    state = F.when(F.coalesce("rate", F.lit(0.0)) <= warn, "PASS").when(F.col("rate") <= fail, "WARN").otherwise("FAIL")
    return long.select(F.lit(section).alias("section"), "check", state.alias("status"), F.round("rate", 6).cast("string").alias("detail"))


def orphans(section: str, check: str, children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    bad = children.filter(F.col(child_key).isNotNull()).join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return bad.select(F.lit(section).alias("section"), F.lit(check).alias("check"), status(F.col("n"), 1, 1).alias("status"), F.col("n").cast("string").alias("detail"))


def allowed(section: str, check: str, df: DataFrame, column: str, values: list[str]) -> DataFrame:
    bad = df.agg(F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(values)).alias("n"))
    return bad.select(F.lit(section).alias("section"), F.lit(check).alias("check"), status(F.col("n"), 1, 1).alias("status"), F.col("n").cast("string").alias("detail"))


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def exit_code(report: DataFrame) -> int:
    return int(not report.filter("status = 'FAIL'").isEmpty())


def duplicates(df: DataFrame, key: Column, ident: str) -> DataFrame:
    """(key, n, first): groups of more than one row; blank keys form none."""
    return df.select(key.alias("key"), F.col(ident)).filter(~is_blank(F.col("key"))).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first")).filter("n > 1")


def variants(df: DataFrame, key: Column, raw: Column) -> DataFrame:
    """(key, spellings): keys written in more than one way; sets are of distinct spellings only."""
    return df.select(key.alias("key"), raw.alias("raw")).filter(~is_blank(F.col("key"))).distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("raw")).alias("spellings")).filter("n > 1")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(left, right, both, rate) of two key sets."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(x, "left").crossJoin(one(y, "right")).crossJoin(one(x.join(y, key, "left_semi"), "both")).withColumn("rate", F.round(F.try_divide("both", "left"), 6))
