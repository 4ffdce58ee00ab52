"""Readers: tables, staged JSON, text and HTML landed as files.  Nothing here reaches a network."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import web
from ..operators import windows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names: list[str], space: str = "") -> None:
    """Temporary views of several tables; ``space`` prefixes those of an attached second set."""
    for n in names:
        table(spark, folder, n).createOrReplaceTempView(f"{space}_{n}" if space else n)


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one array of records each."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def keyed_json(spark: SparkSession, path: str, value_ddl: str) -> DataFrame:
    """(key, value): files with one object whose members are entities."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", f"map<string,{value_ddl}>")).alias("key", "value"))


def text_files(spark: SparkSession, glob: str) -> DataFrame:
    """(file, text) of every file that the pattern matches."""
    return spark.read.text(glob, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("text"))


def merged_records(frames: list[DataFrame], key: Column, items: str) -> DataFrame:
    """(key, items): lists of all records with one normalised key, without repeats, sorted."""
    out = None
    for df in frames:
        part = df.select(key.alias("key"), F.col(items))
        out = part if out is None else out.unionByName(part)
    return out.filter("key <> ''").select("key", F.explode(items).alias("i")).distinct().groupBy("key").agg(F.array_sort(F.collect_list("i")).alias(items))


def decoded(spark: SparkSession, glob: str, encodings: tuple[str, ...] = ("utf-8", "cp932", "shift_jis")) -> DataFrame:
    """(path, encoding, text): bytes in the first encoding that fits, the first one with replacements if none does."""
    raw = spark.read.format("binaryFile").load(glob).select("path", "content")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(p, *_decode(bytes(b), encodings)) for p, b in zip(pdf["path"], pdf["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["path", "encoding", "text"])

    return raw.mapInPandas(run, "path string, encoding string, text string")


def _decode(data: bytes, encodings: tuple[str, ...]) -> tuple[str, str]:
    for e in encodings:
        try:
            return e, data.decode(e)
        except UnicodeDecodeError:
            continue
    return encodings[0], data.decode(encodings[0], errors="replace")


def page_text(pages: DataFrame) -> DataFrame:
    """(doc, page, line, text): pages with text, cut to lines; ``pages`` has doc, page, text."""
    return pages.filter(F.trim("text") != "").select("doc", "page", F.posexplode(F.split("text", "\n")).alias("line", "text"))


def html_rows(html: DataFrame, key: str, column: str) -> DataFrame:
    """(key, place, label, value, href): header and cell of each table row; a link's address is the better URL."""
    rows = html.select(key, F.posexplode(F.regexp_extract_all(column, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("place", "row"))
    part = lambda tag: F.nullif(web.strip_tags(F.regexp_extract("row", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    return rows.select(key, "place", part("th").alias("label"), part("td").alias("value"), F.nullif(F.regexp_extract("row", r"(?is)<td[^>]*>.*?href=[\"']([^\"']+)", 1), F.lit("")).alias("href")).filter("label is not null")


def entries(lines: DataFrame, doc: str, order: str, text: str, header: Column, fields: dict[str, str]) -> DataFrame:
    """One row per entry of a line-based page: a header line opens it, labelled lines fill its fields.

    The entry's number is the running count of headers; lines before the first header belong to none.
    """
    from pyspark.sql import Window

    numbered = lines.withColumn("entry", F.count_if(header).over(Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))).filter("entry > 0")
    value = lambda label: F.nullif(F.trim(F.regexp_extract(text, rf"^\s*{label}\s*[:：]?\s*(.+)$", 1)), F.lit(""))
    return numbered.groupBy(doc, "entry").agg(F.min_by(text, order).alias("name"), *[F.min_by(value(label), F.when(value(label).isNotNull(), F.col(order))).alias(name) for name, label in fields.items()])


def money_mentions(pages: DataFrame, key: str, text: str, chars: int = 50, most: int = 15) -> DataFrame:
    """(key, place, hit, before, after): the first ``most`` amounts of money with their surroundings."""
    found = web.with_context(F.col(text), r"[0-9０-９][0-9０-９,，.]*\s*(?:億|千万|百万|万)?\s*円", chars, most)
    return pages.select(key, F.posexplode(found).alias("place", "m")).select(key, "place", "m.hit", "m.before", "m.after")


def labelled(pages: DataFrame, key: str, text: str, labels: dict[str, str]) -> DataFrame:
    return pages.select(key, *[web.label_value(F.col(text), label).alias(name) for name, label in labels.items()])


def first_by_id_or_name(rows: DataFrame, order: str) -> DataFrame:
    """Search results of all categories and pages, each entity once: by id, or name where it has none."""
    return windows.first_per_key(rows, [F.coalesce("id", "name")], [F.col(order)])


def work_queue(candidates: DataFrame, staged: DataFrame, key: str, missing: Column, order: list[Column], limit: int | None = None) -> DataFrame:
    """Entities that lack a value, by priority, less those already staged; a limit cuts before that, as in a rerun."""
    todo = candidates.filter(missing).orderBy(*order)
    todo = todo.limit(limit) if limit is not None else todo
    return todo.join(staged.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
