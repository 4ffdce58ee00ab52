"""Sums of doubles are added in one order, wherever the rows lie."""

import random

import duckdb

from fundscope.catalog import ORACLES, QUERIES


def test_history_adds_rows_by_key(spark, tmp_path, rows):
    dice, found = random.Random(3), []
    rounded = lambda prices: int(sum_of(prices) + 0.5)

    def sum_of(prices):
        total = 0.0
        for p in prices:
            total += p
        return total

    # sums that are a half when exact, and round otherwise from the last row to the first
    while len(found) < 20:
        p = [dice.randint(100_000, 50_000_000) for _ in range(5)]
        p[4] += (50 - sum(p)) % 100
        p = [x / 100 for x in p]
        if rounded(p) != rounded(p[::-1]):
            found.append(p)
    orders = [(5 * c + k, c, price) for c, prices in enumerate(found) for k, price in enumerate(prices)]
    df = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").selectExpr("*", "timestamp'1997-05-01' AS o_orderdate")
    df.orderBy("o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/straight")
    df.orderBy(df.o_orderkey.desc()).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = rows(QUERIES["history_arr"](spark, str(tmp_path)))
    assert got == sorted(((c, f"1997:{rounded(p)}", rounded(p)) for c, p in enumerate(found)), key=repr)
    con = duckdb.connect(config={"threads": 1})
    con.sql(f"CREATE VIEW orders AS FROM '{tmp_path}/straight/*.parquet'")
    assert got == sorted(con.sql(ORACLES["history_arr"]).fetchall(), key=repr)
