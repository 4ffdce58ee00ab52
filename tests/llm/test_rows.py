"""Row keys and side files: nothing is lost, doubled or read as empty."""

import corpus_pipeline
import pytest
from conftest import SF
from pyspark.sql import functions as F

from fundscope.llm import mixing
from fundscope.llm.common import Places, open_fs, put_cells, rows_at, shared_dir, with_row_key, written


def distinct_keys(df):
    keyed = with_row_key(df, "k")
    assert keyed.columns == [*df.columns, "k"]
    return keyed.count(), keyed.select("k").distinct().count()


def test_every_row_of_any_frame_has_a_key_of_its_own(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    twice = docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    assert distinct_keys(docs) == (1000, 1000)
    assert distinct_keys(twice) == (2000, 2000)
    assert distinct_keys(docs.crossJoin(spark.range(3))) == (3000, 3000)
    assert distinct_keys(docs.union(docs)) == (2000, 2000)
    assert distinct_keys(docs.join(docs.select("doc_id"), "doc_id")) == (1000, 1000)
    assert distinct_keys(docs.filter("doc_id % 2 = 0").withColumn("_metadata", F.lit(1)))[0] == 500
    assert distinct_keys(docs.limit(0)) == (0, 0)
    again = with_row_key(docs, "k")
    assert again.exceptAll(with_row_key(docs, "k")).count() == 0


def test_many_files_are_numbered_by_a_table(spark, monkeypatch):
    docs = written(spark.range(500).repartition(23), shared_dir(spark, "parts"))
    assert distinct_keys(docs) == (500, 500)
    monkeypatch.setattr("fundscope.llm.common.MOST_FILES", 5)
    assert distinct_keys(docs) == (500, 500)


def test_mix_of_exploded_rows_keeps_its_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    plan = mixing.mix(docs).agg(F.sum("words")).first()[0]
    out = mixing.mixed(docs).agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert plan == out > 0
    assert mixing.taken(mixing.mix(docs)).count() == docs.count()


def test_one_of_each_class_of_exploded_rows(spark):
    texts = [" ".join(f"{c}{k}" for k in range(30)) for c in "abc"]
    rows = written(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"), shared_dir(spark, "d"))
    twice = rows.withColumn("n_chars", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))))
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each_class(spark, twice, "").collect()) == [0, 1, 2]


def test_mixed_without_the_named_length_column(spark):
    docs = spark.createDataFrame([(i, "one two three four five", "ab"[i % 2]) for i in range(9)], "doc_id long, text string, source string")
    assert mixing.mixed(docs, length="n_chars").count() > 0


def test_a_missing_side_file_is_an_error(spark):
    keyed = with_row_key(written(spark.range(10).coalesce(1), shared_dir(spark, "t")), "k")
    folder = Places.put(keyed.filter("id < 3").select("k"), "k", "side")
    side = Places(folder)
    assert sorted(k for at, _ in side.matches(__import__("numpy").arange(10), "k") for k in at.tolist()) == sorted(r.k for r in keyed.filter("id < 3").collect())
    fs, root = open_fs(folder)
    for f in fs.get_file_info(__import__("pyarrow").fs.FileSelector(root)):
        if f.path.endswith(".arrow"):
            fs.delete_file(f.path)
    with pytest.raises(FileNotFoundError):
        list(Places(folder).matches(__import__("numpy").arange(10), "k"))
    fs.delete_dir(f"{root}/cells")
    with pytest.raises(FileNotFoundError):
        list(Places(folder).matches(__import__("numpy").arange(10), "k"))


def test_cells_without_rows_and_a_late_attempt(spark):
    folder = shared_dir(spark, "cells")
    put_cells(spark.range(0).selectExpr("id as c", "id"), ["c"], ["id"], folder)
    assert list(Places(folder).matches(__import__("numpy").arange(3), "id")) == []
    folder = Places.put(spark.range(5).withColumnRenamed("id", "k"), "k", "late")
    fs, root = open_fs(folder)
    with fs.open_output_stream(f"{root}/late.arrow") as out:  # what an attempt that doesn't count leaves
        out.write(b"half a file")
    assert sum(t.num_rows for _, t in Places(folder).matches(__import__("numpy").arange(5), "k")) == 5


def test_rows_at_finds_all(spark):
    docs = written(spark.range(1000).withColumn("t", F.col("id").cast("string")).repartition(7), shared_dir(spark, "t"))
    keyed = with_row_key(docs, "k")
    assert rows_at(keyed, keyed.filter("id % 3 = 0"), "k", docs).count() == 334
