"""Substring search over a stored index of grams, kept up by batches.

The index holds a posting for every place of every text: the three characters that begin there, folded like ``ilike``
folds.  A posting knows its place, so a term occurs exactly where the grams that cover it stand at the right distances:
the texts are not read again.  Postings lie in partitions by their gram's first two characters and in the order of gram and
key within their files, so a search opens the partitions of its term's grams and, in them, the row groups that hold those.
Files are cut by gram and key together: a gram that every text has is spread over as many files as it fills.

A batch of new, changed or emptied rows is a folder of its own, which counts from the moment at which the list of batches
names it; the list is written last, in one commit of Spark's.  A row's latest batch alone counts for it.  There may be one
writer at a time, and any number of readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a gram.
SIZE = 3
#: Characters of a gram that choose its partition.
HEAD = 2


def _part(head: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(head), F.lit(parts)).cast("int")


def _postings(rows: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """(part, gram, key, field, place): the last two places of a text have shorter grams, which short terms need."""
    text = F.array(*[F.struct(F.lit(k).alias("field"), F.lower(F.col(f"`{c}`").cast("string")).alias("text")) for k, c in enumerate(columns)])
    fields = rows.select("key", F.explode(text).alias("f")).select("key", "f.field", "f.text").filter("text <> ''")
    # characters are cut once for a text, so that long ones take time in proportion
    chars = fields.select("key", "field", F.filter(F.split("text", ""), lambda x: x != "").alias("chars"))
    cut = F.transform("chars", lambda c, k: F.concat_ws("", c, *[F.get("chars", k + j) for j in range(1, SIZE)]))
    found = chars.select("key", "field", F.posexplode(cut).alias("place", "gram"))
    return found.select(_part(F.substring("gram", 1, HEAD), parts).alias("part"), "gram", "key", "field", "place")


class GramIndex:
    """An index below ``folder`` over ``columns`` of rows with a unique ``key``, shown by ``label``.

    Null keys are refused, as are keys that repeat within a batch.  Null and empty texts hold nothing but the empty term,
    which lies in every text that isn't null.  ``parts`` is fixed when the index is made.  A reader keeps to the batches
    that it found when it opened the index, until ``refresh``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        made = spark.read.parquet(f"{self.folder}/index").first()
        self.columns, self.label, self.parts = list(made["columns"]), made["label"], made["parts"]
        self.schemas = {"postings": f"gram string, key {made['key']}, field int, place int, part int", "rows": f"key {made['key']}, label string, held boolean"}
        self.refresh()

    @classmethod
    def build(cls, rows: DataFrame, key: str, columns: Sequence[str], label: str, folder: str, parts: int = 256) -> GramIndex:
        """A new index with ``rows`` as its first batch."""
        spark, folder = rows.sparkSession, folder.rstrip("/")
        kind = rows.schema[key].dataType.simpleString()
        out = cls._made(spark, folder, list(columns), label, parts, kind)
        out.add(rows, key)
        return out

    @classmethod
    def _made(cls, spark: SparkSession, folder: str, columns: list[str], label: str, parts: int, kind: str) -> GramIndex:
        spark.createDataFrame([], "batch int, name string").write.parquet(f"{folder}/list/{0:08d}")
        spark.createDataFrame([(columns, label, parts, kind)], "columns array<string>, label string, parts int, key string").coalesce(1).write.parquet(f"{folder}/index")
        return cls(spark, folder)

    def refresh(self) -> None:
        """Look which batches count now: (number, folder) of each, oldest first.  ``compact`` makes them one."""
        rows = self.spark.read.schema("batch int, name string").parquet(f"{self.folder}/list/*").collect()
        self.batches = sorted((r.batch, r.name) for r in rows)

    def add(self, rows: DataFrame, key: str) -> None:
        """Enter a batch: each row replaces what the index has of its key; a row whose texts are null takes it out."""
        rows = rows.withColumn("key", F.col(f"`{key}`"))
        n, nulls, distinct = rows.agg(F.count(F.lit(1)), F.count_if(F.col("key").isNull()), F.count_distinct("key")).first()
        if nulls or distinct != n:
            raise ValueError(f"{nulls} rows without a key, {n - nulls - distinct} with one of another row")
        held = reduce(Column.__or__, [F.col(f"`{c}`").isNotNull() for c in self.columns])
        self._enter(_postings(rows, self.columns, self.parts), rows.select("key", F.col(f"`{self.label}`").cast("string").alias("label"), held.alias("held")))

    def _enter(self, postings: DataFrame, rows: DataFrame) -> None:
        self.refresh()
        number, name = max((b for b, _ in self.batches), default=0) + 1, uuid.uuid4().hex
        where = f"{self.folder}/batches/{name}"
        postings.repartitionByRange("part", "gram", "key").sortWithinPartitions("part", "gram", "key").write.partitionBy("part").parquet(f"{where}/postings")
        rows.repartitionByRange("key").sortWithinPartitions("key").write.parquet(f"{where}/rows")
        self.spark.createDataFrame([(number, name)], "batch int, name string").coalesce(1).write.parquet(f"{self.folder}/list/{number:08d}")
        self.refresh()

    def _all(self, what: str) -> DataFrame:
        """The batches' tables of one kind, with the number of the batch."""
        frames = [self.spark.read.schema(self.schemas[what]).parquet(f"{self.folder}/batches/{name}/{what}").withColumn("batch", F.lit(n)) for n, name in self.batches]
        return reduce(DataFrame.unionByName, frames)

    def _latest(self, found: DataFrame) -> DataFrame:
        """Those of (key, batch, ...) that no later batch has written again."""
        if len(self.batches) == 1:
            return found
        later = self._all("rows").filter("batch > 1").groupBy("key").agg(F.max("batch").alias("last"))
        return found.join(later, "key", "left").filter("last is null or last <= batch").drop("last")

    def keys(self, term: str) -> DataFrame:
        """(key, batch) of the rows of which a text contains ``term``, case aside."""
        # folded where the texts were folded
        term = self.spark.range(1).select(F.lower(F.lit(term))).first()[0]
        if not term:
            return self._latest(self._all("rows").filter("held").select("key", "batch"))
        postings = self._all("postings")
        if len(term) < SIZE:
            near = F.startswith("gram", F.lit(term))
            if len(term) >= HEAD:
                near &= F.col("part") == self._parts([term[:HEAD]])[0]
            return self._latest(postings.filter(near).select("key", "batch").distinct())
        # grams that cover the term: one after the other, and the last
        offsets = sorted({*range(0, len(term) - SIZE + 1, SIZE), len(term) - SIZE})
        grams: dict[str, list[int]] = {}
        for k in offsets:
            grams.setdefault(term[k : k + SIZE], []).append(k)
        wanted = F.col("part").isin(sorted(set(self._parts([g[:HEAD] for g in grams])))) & F.col("gram").isin(list(grams))
        hits = postings.filter(wanted)
        if len(offsets) > 1:
            at = F.lit(None).cast("array<int>")
            for gram, ks in grams.items():
                at = F.when(F.col("gram") == gram, F.array(*map(F.lit, ks))).otherwise(at)
            starts = hits.select("key", "batch", "field", "place", F.explode(at).alias("at")).withColumn("start", F.col("place") - F.col("at")).filter("start >= 0")
            hits = starts.groupBy("key", "batch", "field", "start").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(offsets))
        return self._latest(hits.select("key", "batch").distinct())

    def _parts(self, heads: list[str]) -> list[int]:
        return list(self.spark.range(1).select(*[_part(F.lit(h), self.parts) for h in heads]).first())

    def search(self, term: str, limit: int | None = None) -> DataFrame:
        """(key, label) of the rows that contain the term; with ``limit`` the first ones by key."""
        found = self.keys(term)
        if limit is not None:
            found = found.orderBy("key").limit(limit)
        return found.join(self._all("rows"), ["key", "batch"]).select("key", "label")

    def compact(self, folder: str) -> GramIndex:
        """The same index in a new folder, as one batch without what later batches have replaced."""
        kind = self._all("rows").schema["key"].dataType.simpleString()
        out = GramIndex._made(self.spark, folder.rstrip("/"), self.columns, self.label, self.parts, kind)
        out._enter(self._latest(self._all("postings")).drop("batch"), self._latest(self._all("rows")).drop("batch"))
        return out


def search_all(indexes: dict[str, GramIndex], query: str, limit: int) -> DataFrame:
    """(kind, id, label): what ``plans.views.search`` gives, by the indexes of the tables instead of their scans."""
    one = lambda kind, index: index.search(query, limit).select(F.lit(kind).alias("kind"), F.col("key").cast("string").alias("id"), "label")
    return reduce(DataFrame.unionByName, [one(k, v) for k, v in indexes.items()])
