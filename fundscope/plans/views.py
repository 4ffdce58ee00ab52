"""Views over the star, and the cross-source query surface."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact_awards(results: DataFrame, calls: DataFrame, programs: DataFrame, orgs: DataFrame) -> DataFrame:
    """Results with their call, programme and organisation; duplicates of organisations count for the primary."""
    c = calls.select(F.col("id").alias("call_id"), "program_id", F.col("title").alias("call_title"))
    p = programs.select(F.col("id").alias("program_id"), "organization_id", F.col("name").alias("program_name"))
    o = orgs.select(F.col("id").alias("organization_id"), F.col("name").alias("organization_name"), "duplicate_of")
    return results.join(c, "call_id").join(p, "program_id").join(o, "organization_id").withColumn("organization_id", F.coalesce("duplicate_of", "organization_id")).drop("duplicate_of")


def grants_overview(orgs: DataFrame, programs: DataFrame, calls: DataFrame) -> DataFrame:
    p = programs.select(F.col("id").alias("program_id"), "organization_id", F.col("name").alias("program_name"), "category")
    o = orgs.select(F.col("id").alias("organization_id"), F.col("name").alias("organization_name"), "corporate_parent")
    return calls.join(p, "program_id").join(o, "organization_id").select("organization_name", "corporate_parent", "program_name", "category", F.col("id").alias("call_id"), "title", "fiscal_year", "status", "application_deadline", "grant_amount_max")


def foundation_summary(orgs: DataFrame, programs: DataFrame, calls: DataFrame) -> DataFrame:
    """Programmes, calls and amounts per organisation, those without any included; calls aggregate before the join."""
    c = calls.groupBy("program_id").agg(F.count(F.lit(1)).alias("calls"), F.max("grant_amount_max").alias("most"), F.min("grant_amount_min").alias("least"))
    p = programs.join(c, programs["id"] == c["program_id"], "left").groupBy("organization_id").agg(F.count(F.lit(1)).alias("programs"), F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"), F.max("most").alias("most"), F.min("least").alias("least"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))
    return orgs.select("id", "name").join(p, orgs["id"] == p["organization_id"], "left").select("id", "name", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("programs", "calls")], "most", "least", "categories")


def grant_calls_for(cfg_id: str, mapping: DataFrame, calls: DataFrame, programs: DataFrame) -> DataFrame:
    """Calls of the external organisation that an own one is mapped to."""
    ids = mapping.filter(F.col("cfg_id") == cfg_id).select(F.col("grant_db_id").alias("organization_id"))
    p = programs.join(ids, "organization_id", "left_semi").select(F.col("id").alias("program_id"), F.col("name").alias("program_name"))
    return calls.join(p, "program_id")


def search(parts: dict[str, tuple[DataFrame, str, list[str], str]], query: str, limit: int) -> DataFrame:
    """(kind, id, label): rows of every table with the query in one of its columns, case aside, ``limit`` of each.

    ``parts``: kind -> (table, id column, searched columns, label column).  Limits are taken in the order of the id.
    """
    pattern = "%" + query.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"

    def one(kind: str, df: DataFrame, key: str, columns: list[str], label: str) -> DataFrame:
        hit = reduce(Column.__or__, [F.coalesce(F.col(c).ilike(pattern), F.lit(False)) for c in columns])
        return df.filter(hit).orderBy(key).limit(limit).select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.col(label).alias("label"))

    return reduce(DataFrame.unionByName, [one(k, *v) for k, v in parts.items()])


def upcoming(own: DataFrame, external: DataFrame, as_of: str, limit: int) -> DataFrame:
    """Open or future calls of both sources, nearest deadline first, unknown deadlines last; each source limited too."""
    open_ = (F.col("deadline") >= as_of) | (F.col("status") == "open")
    far = F.coalesce("deadline", F.lit("9999-12-31"))
    part = lambda df, tag: df.filter(open_).orderBy(far, "id").limit(limit).select(F.lit(tag).alias("source"), "id", "title", "deadline", "status")
    return part(own, "CFG").unionByName(part(external, "GDB")).orderBy(far, "source", "id").limit(limit)


def scalars(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each table."""
    ones = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    return reduce(DataFrame.crossJoin, ones)
