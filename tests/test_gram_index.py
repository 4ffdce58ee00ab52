"""The stored index of grams against a scan with ``ilike``."""

import random

import pytest
from pyspark.sql import functions as F

from fundscope.operators.gram_index import GramIndex
from fundscope.plans import views

SCHEMA = "id long, name string, note string"


def drawn(rng, n, start=0):
    word = lambda: "".join(rng.choice("abAB%_é京\\ ") for _ in range(rng.randrange(0, 14)))
    return [(start + i, rng.choice([word(), word(), None, ""]), rng.choice([word(), None])) for i in range(n)]


def check(spark, rows, index, table, terms, limit=None):
    df = spark.createDataFrame(table, SCHEMA)
    for term in terms:
        want = views.search({"x": (df, "id", ["name", "note"], "name")}, term, limit or 10**6)
        assert rows(index.search(term, limit).select("key", "label")) == rows(want.select(F.col("id").cast("long"), "label")), term


def test_equals_a_scan_through_batches_and_compaction(spark, tmp_path, rows):
    rng = random.Random(11)
    table = drawn(rng, 120) + [(500, "x" * 30_000 + "needle in a very long text", None)]
    terms = ["", "é", "AB", "b%", "\\", "aba", "%_é", "ba京 b", "needle in a very", "xxxxxxx", "zz"]
    index = GramIndex.build(spark.createDataFrame(table, SCHEMA), "id", ["name", "note"], "name", str(tmp_path / "i"), 8)
    check(spark, rows, index, table, terms)
    check(spark, rows, index, table, ["a", ""], 3)
    batch = drawn(rng, 25) + drawn(rng, 10, 1000) + [(30, None, None), (500, "needle", None)]
    index.add(spark.createDataFrame(batch, SCHEMA), "id")
    last = [(31, "abab", "ba京 b")]
    index.add(spark.createDataFrame(last, SCHEMA), "id")
    now = list({r[0]: r for r in table + batch + last}.values())
    check(spark, rows, index, now, terms[::3])
    again = GramIndex(spark, str(tmp_path / "i")).compact(str(tmp_path / "j"))
    assert len(again.batches) == 1 and len(index.batches) == 3
    check(spark, rows, again, now, terms[1::3])


def test_reads_only_the_partitions_of_the_term(spark, tmp_path):
    table = [(i, f"name {i * 7919 % 1000:03d} end", None) for i in range(1000)]
    index = GramIndex.build(spark.createDataFrame(table, SCHEMA), "id", ["name", "note"], "name", str(tmp_path / "i"), 64)
    found = index.keys("791 e")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and "gram" in plan.split("PushedFilters")[1] and found.count() == 1
    opened = {f.split("part=")[1].split("/")[0] for f in spark.read.parquet(f"{index.folder}/batches/{index.batches[0][1]}/postings").filter(F.col("part").isin(index._parts(["79", "1 "]))).select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert 1 <= len(opened) <= 2


def test_edges(spark, tmp_path, rows):
    empty = GramIndex.build(spark.createDataFrame([], SCHEMA), "id", ["name", "note"], "name", str(tmp_path / "e"), 4)
    assert [empty.search(x).count() for x in ("", "a", "abc")] == [0, 0, 0]
    for bad in ([(None, "a", "b")], [(1, "a", "b"), (1, "c", "d")]):
        with pytest.raises(ValueError):
            empty.add(spark.createDataFrame(bad, SCHEMA), "id")
    # what a writer that died has left is not named by the list
    spark.createDataFrame([(0, "abc", 9, 0, 0)], "part int, gram string, key long, field int, place int").write.partitionBy("part").parquet(f"{empty.folder}/batches/lost/postings")
    assert empty.search("abc").count() == 0
    named = GramIndex.build(spark.createDataFrame([(1, "abc", "k")], "key long, label string, batch string"), "key", ["label", "batch"], "label", str(tmp_path / "n"), 4)
    assert rows(named.search("K")) == [(1, "abc")]
