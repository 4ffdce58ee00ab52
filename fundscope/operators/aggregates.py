"""Aggregation operators: shares, concentration, medians, coverage, histograms, profiles, hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored


def every():
    """The whole input as one window; for small, aggregated inputs."""
    return Window.partitionBy(F.lit(1))


def hhi(counts: DataFrame, n: str = "n", by: Sequence[str] = (), scale: float = 10_000.0) -> DataFrame:
    """Concentration sum(share**2) * scale per group of ``by``, with the number of members and the top share.

    ``counts`` has a row per member; 0 for an empty input.
    """
    total = F.sum(n)
    agg = [
        F.coalesce(F.round(scale * F.sum(F.col(n) * F.col(n)) / F.nullif(total * total, F.lit(0)), 6), F.lit(0.0)).alias("hhi"),
        F.count(F.lit(1)).alias("members"),
        F.round(F.max(n) / F.nullif(total, F.lit(0)), 6).alias("top_share"),
    ]
    return counts.groupBy(*by).agg(*agg)


def upper_median(c: str) -> Column:
    """The element at n // 2 of the sorted values of a column: the upper one of the middle two.

    Discrete percentiles round down, so it is the middle one in falling order; partial results count distinct values.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}` DESC)")


def with_share(df: DataFrame, n: str, by: Sequence[str] = (), digits: int = 6, name: str = "share") -> DataFrame:
    w = Window.partitionBy(*by) if by else every()
    return df.withColumn(name, F.round(F.col(n) / F.sum(n).over(w), digits))


def representation(a: DataFrame, b: DataFrame, key: str, least: int = 8) -> DataFrame:
    """(key, share_a, share_b, ratio, gap) of two counted distributions (key, n), for keys with ``least`` in ``a``."""
    left = with_share(a, "n", name="share_a").filter(F.col("n") >= least).select(key, "share_a")
    right = with_share(b, "n", name="share_b").select(key, "share_b")
    return left.join(right, key, "left").withColumns({"ratio": F.round(F.try_divide("share_a", "share_b"), 6), "gap": F.round(F.col("share_a") - F.coalesce("share_b", F.lit(0.0)), 6)})


def intensity(base: DataFrame, hits: DataFrame, key: str, least: int, per: float = 1000.0) -> DataFrame:
    """``per`` times hits by base size, for bases of at least ``least``; both (key, n)."""
    return base.filter(F.col("n") >= least).select(key, F.col("n").alias("base")).join(hits.select(key, F.col("n").alias("hits")), key, "left").withColumns({"hits": F.coalesce("hits", F.lit(0))}).withColumn("per_base", F.round(per * F.col("hits") / F.col("base"), 6))


def bucket(c: Column, edges: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first edge that the value is below; an edge of None takes the rest; NULL stays NULL."""
    out = None
    for edge, label in edges:
        test = c.isNotNull() if edge is None else c < edge
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def histogram(df: DataFrame, c: Column, edges: Sequence[tuple[float | None, str]], amount: Column | None = None) -> DataFrame:
    """(bucket, place, n[, amount]) with every bucket, empty ones with 0."""
    spark = df.sparkSession
    frame = spark.createDataFrame([(k, label) for k, (_, label) in enumerate(edges)], "place int, bucket string")
    aggs = [F.count(F.lit(1)).alias("n")] + ([F.sum(amount).alias("amount")] if amount is not None else [])
    counted = df.groupBy(bucket(c, edges).alias("bucket")).agg(*aggs)
    return F.broadcast(frame).join(counted, "bucket", "left").na.fill(0)


def coverage(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """(item, filled, total, percent): one pass over the table, then a row per test."""
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(t).alias(k) for k, t in tests.items()])
    long = one.unpivot(["total"], list(tests), "item", "filled")
    return long.select("item", "filled", "total", F.round(F.try_divide(100.0 * F.col("filled"), F.col("total")), 2).alias("percent"))


def verdict(percent: Column, warn: float, fail: float) -> Column:
    return F.when(percent >= warn, "PASS").when(percent >= fail, "WARN").otherwise("FAIL")


def top_share(counts: DataFrame, n: str, order: Sequence[Column], k: int) -> DataFrame:
    """Share of the first ``k`` members in the total: a bounded top-k and one sum, no global sort."""
    top = counts.orderBy(*order).limit(k).agg(F.sum(n).alias("top"))
    return top.crossJoin(counts.agg(F.sum(n).alias("total"), F.count(F.lit(1)).alias("members"))).select("members", "total", F.round(F.col("top") / F.col("total"), 6).alias("share"))


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group; Spark limits each group before it shuffles."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def multi_member(df: DataFrame, row: str, labels: str, amount: str, most: float) -> DataFrame:
    """Each row counts once for every label it has; amounts outside [0, most] count as 0, averages over positive ones."""
    each = df.select(row, F.explode(F.array_distinct(labels)).alias("label"), F.when(F.col(amount).between(0, most), F.col(amount)).otherwise(0).alias("a"))
    return each.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("a"), 2).alias("total"), F.avg(F.when(F.col("a") > 0, F.col("a"))).cast("long").alias("average"))


def rolled_up(leaves: DataFrame, levels: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """(level columns, depth, sums): parents add up their children, so a row under two children counts twice."""
    out = None
    for depth in range(len(levels), 0, -1):
        part = leaves.groupBy(*levels[:depth]).agg(*[F.sum(s).alias(s) for s in sums])
        part = part.select(*levels[:depth], *[F.lit(None).cast("string").alias(x) for x in levels[depth:]], F.lit(depth).alias("depth"), *sums)
        out = part if out is None else out.unionByName(part)
    return out


def log_score(df: DataFrame, share: str, name: str = "norm") -> DataFrame:
    """log1p of the share at two decimals, scaled so that the largest becomes 100."""
    v = F.log1p(F.round(share, 2))
    return df.withColumn(name, F.coalesce(100 * v / F.nullif(F.max(v).over(every()), F.lit(0.0)), F.lit(0.0)))


def zero_filled_union(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Counts (key, n) of several sources side by side over all their keys, 0 where a source lacks one.

    A union and one aggregation instead of a chain of full outer joins.
    """
    long = None
    for name, df in frames.items():
        part = df.select(key, F.lit(name).alias("source"), F.col("n"))
        long = part if long is None else long.unionByName(part)
    return long.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("source") == s, F.col("n"))), F.lit(0)).alias(s) for s in frames])


def order_statistics(df: DataFrame, by: str, value: str, share: float = 0.5, few: int = 100_000, cells: int = 1024) -> DataFrame:
    """(by, n, lower, upper): the values next to ``share`` of each group's order, exactly, whatever a group's size.

    Of n values (NULL and NaN don't count) these are those of the places floor(share * (n - 1)) and ceil(share * (n - 1)),
    so the median is their mean and the upper median is ``upper``.  Groups of up to ``few`` rows are sorted as windows.
    Larger ones, of which there are at most rows / ``few``, are never brought together: each pass counts a group's values in
    ``cells`` equal parts of the range that still holds a place, with partial counts before the shuffle, and goes on in the
    part that has it, until that has one value or few rows.
    """
    data = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    known = stored(data.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "groups")
    places = F.explode(F.array(F.struct(F.lit("lower").alias("which"), F.floor(share * (F.col("n") - 1)).alias("place")), F.struct(F.lit("upper").alias("which"), F.ceil(share * (F.col("n") - 1)).alias("place"))))
    # rows from lo to hi: m of them, of which the place counts from 0
    todo = known.select("g", "n", "lo", "hi", places.alias("p")).select("g", "n", "p.which", "p.place", "lo", "hi", F.col("n").alias("m"))
    done = []
    while True:
        todo = stored(todo, "ranges")
        done.append(todo.filter("lo = hi").select("g", "n", "which", F.col("lo").alias("v")))
        todo = todo.filter("lo < hi")
        small = todo.filter(F.col("m") <= few)
        mine = data.withColumnRenamed("g", "_g").join(small, F.col("_g").eqNullSafe(F.col("g")) & F.col("v").between(F.col("lo"), F.col("hi")))
        order = Window.partitionBy("g", "which").orderBy("v")
        done.append(mine.withColumn("_k", F.row_number().over(order) - 1).filter("_k = place").select("g", "n", "which", "v"))
        large = todo.filter(F.col("m") > few)
        if large.isEmpty():
            break
        # at most two rows for each ``few`` rows of the table: a bound that the broadcast rests on
        rows = data.withColumnRenamed("g", "_g").join(F.broadcast(large), F.col("_g").eqNullSafe(F.col("g")) & F.col("v").between(F.col("lo"), F.col("hi")))
        half = F.col("hi") / 2 - F.col("lo") / 2
        cell = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / half * cells), F.lit(cells - 1))
        # the ends have parts of their own, so that every pass leaves some behind
        cell = F.when(F.col("v") == F.col("lo"), -1).when(F.col("v") == F.col("hi"), cells).otherwise(cell)
        counts = rows.groupBy("g", "n", "which", "place", cell.alias("cell")).agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = Window.partitionBy("g", "which").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        todo = counts.withColumn("_before", F.coalesce(F.sum("m").over(upto), F.lit(0))).filter("place >= _before and place < _before + m").select("g", "n", "which", (F.col("place") - F.col("_before")).alias("place"), "lo", "hi", "m")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.groupBy(F.col("g").alias(by), "n").agg(F.max(F.when(F.col("which") == "lower", F.col("v"))).alias("lower"), F.max(F.when(F.col("which") == "upper", F.col("v"))).alias("upper"))
