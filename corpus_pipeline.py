"""The corpus pipeline: quality, near duplicates, benchmark decontamination, source mix, token files.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.llm import decontam, mixing, ngram_join, quality, token_store
from fundscope.llm.common import load, result_only, rows_at, shared_dir, unused, with_row_key, written
from fundscope.llm.queries import tokenizer

#: No SQL: a compression classifier, a randomised join and a tokenizer are in it.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1, from labels that aren't held out.

    Null and empty texts get the base rate of the labels; repeated rows are judged alike; an empty table stays empty.
    """
    known = load(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    return quality.keep(docs, quality.fit(docs, known))


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: the least doc_id, rows without an id last, the first as stored of equal ones.

    Rows are told apart by a key of their own, as ids may be repeated or null.  Null texts and texts without words are
    classes of their own and stay; an empty table stays empty.  The texts aren't shuffled: the tasks that read them look
    up which of their rows stay.
    """
    key = unused(docs, "row_key")
    keyed = with_row_key(docs, key)
    classes = result_only(spark, lambda: ngram_join.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), row="doc_id"), "classes")
    # a row without links is a class of its own
    linked = classes.filter("n_links > 0").select(F.col("doc_id").alias("row"), "class_id")
    ids = keyed.select(F.col(key).alias("row"), F.col("doc_id").alias("id"))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    best = linked.join(ids.hint("merge"), "row").groupBy("class_id").agg(F.min(first).alias("first"))
    kept = classes.filter("n_links = 0").select(F.col("doc_id").alias(key)).unionByName(best.select(F.col("first.row").alias(key)))
    return rows_at(keyed, kept, key, docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts stay, repeated rows are judged alike."""
    return decontam.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shards of the mix: documents as often as it takes them, whole, and cut where a source's target ends in one.

    Documents without words are in no block and go; a null source is a source of its own; rows that share an id keep their
    own counts; an empty table stays empty.
    """
    return mixing.mixed(docs, length="n_chars")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digest of the token files, read back: (doc_id, start, n_tokens, ids_crc32).

    Null and empty texts have the end id alone; null ids come first; a repeated id has a row for each document.
    """
    return token_store.digest(token_store.token_files(docs, tokenizer()))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_class),
    ("decontamination", drop_leaks),
    ("mix", mix_sources),
    ("token_files", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), shared_dir(spark, f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
