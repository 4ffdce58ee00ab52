"""Composed reports over the star: the structural report, the dashboard and the verification suite.

Each is a set of named frames, or one long frame (section, label, other, n, amount) of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import checks
from ..operators import rules as R
from .views import scalars

# Yearly amounts that part the tiers, in yen.
TIERS = [(50_000_000, "T1"), (100_000_000, "T2"), (500_000_000, "T3"), (1_000_000_000, "T4"), (5_000_000_000, "T5"), (None, "T6")]

_UNSET = "unset"


def _long(section: str, df: DataFrame, label, other=None, n="n", amount=None) -> DataFrame:
    text = lambda c: F.lit(None).cast("string") if c is None else F.col(c).cast("string")
    value = F.lit(None).cast("double") if amount is None else F.col(amount).cast("double")
    return df.select(F.lit(section).alias("section"), text(label).alias("label"), text(other).alias("other"), F.col(n).cast("long").alias("n"), value.alias("amount"))


def structural(orgs: DataFrame, programs: DataFrame, focus: DataFrame, categories: DataFrame) -> DataFrame:
    """Long frame: programmes and organisations by subtype and field, fields by tier of amount, programmes by subcategory,
    organisations by field, and totals.

    ``orgs``: id, subtype, amount; ``programs``: id, organization_id, subcategories; ``focus``: organization_id,
    category_id; ``categories``: id, level, name.  A programme belongs to a subcategory whose id lies in its text.
    """
    o = orgs.select(F.col("id").alias("organization_id"), "subtype", "amount")
    fields = focus.join(categories.filter("level = 1").select(F.col("id").alias("category_id"), F.col("name").alias("field")), "category_id").select("organization_id", "field")
    p = programs.select(F.col("id").alias("program"), "organization_id", "subcategories")
    matrix = p.join(o, "organization_id").join(fields, "organization_id", "left").groupBy("subtype", "field").agg(F.countDistinct("program").alias("n"), F.countDistinct("organization_id").alias("amount"))
    tiers = fields.join(o.filter("amount is not null"), "organization_id").groupBy("field", A.bucket(F.col("amount"), TIERS).alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    # a subcategory is a rule whose keyword is its id, so one pass over the programmes finds them all
    second = categories.filter("level = 2").select(F.col("id").alias("keyword"), F.col("name").alias("label"))
    rules = second.withColumn("ord", F.row_number().over(Window.orderBy("keyword"))).withColumn("weight", F.lit(1.0))
    hits = R.long_matches(p, "program", "subcategories", rules).join(rules.select("ord", "label"), "ord").join(p, "program")
    level2 = hits.groupBy("label").agg(F.countDistinct("program").alias("n"), F.countDistinct("organization_id").alias("amount"))
    first = categories.filter("level = 1").select(F.col("name").alias("field"))
    covered = first.join(fields.distinct().groupBy("field").agg(F.count(F.lit(1)).alias("n")), "field", "left").na.fill(0, ["n"])
    totals = orgs.agg(F.count("amount").alias("n"), F.sum("amount").alias("amount"))
    parts = [
        _long("subtype_field", matrix, "subtype", "field", amount="amount"),
        _long("field_tier", tiers, "field", "tier", amount="amount"),
        _long("subcategory", level2, "label", amount="amount"),
        _long("field_coverage", covered, "field"),
        _long("amounts", totals, None, amount="amount"),
    ]
    return reduce(DataFrame.unionByName, parts)


def dashboard(orgs: DataFrame, programs: DataFrame, calls: DataFrame, groups: dict[str, int | None], top: int = 30) -> DataFrame:
    """Long frame: organisations by each column of ``groups`` (its most frequent values, if a number is given), tiers of
    amounts, the largest organisations, and the numbers of rows.  ``orgs``: id, name, amount and the columns of ``groups``."""
    parts = []
    for column, most in groups.items():
        counted = orgs.groupBy(F.coalesce(column, F.lit(_UNSET)).alias("label")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(_long(column, counted.orderBy(F.desc("n"), "label").limit(most) if most else counted, "label"))
    known = orgs.filter("amount is not null")
    parts.append(_long("tier", known.groupBy(A.bucket(F.col("amount"), TIERS).alias("label")).agg(F.count(F.lit(1)).alias("n")), "label"))
    largest = known.orderBy(F.desc("amount"), "id").limit(top).withColumn("n", F.lit(1))
    parts.append(_long("largest", largest, "name", amount="amount"))
    rows = scalars(organizations=orgs, programs=programs, calls=calls).unpivot([], ["organizations", "programs", "calls"], "label", "n")
    parts.append(_long("rows", rows, "label"))
    return reduce(DataFrame.unionByName, parts)


def suite(tables: dict[str, DataFrame], tests: list[tuple], references: list[tuple], unique: list[tuple]) -> DataFrame:
    """(section, check, status, detail) of all checks.

    ``tests``: (section, check, table, predicate of bad rows, warn from, fail from or None), a pass per table;
    ``references``: (section, check, child, child key, parent, parent key); ``unique``: (section, check, table, column).
    """
    parts = []
    for section, table in dict.fromkeys((t[0], t[2]) for t in tests):
        mine = {c: (F.coalesce(F.expr(bad), F.lit(False)), warn, fail) for s, c, t, bad, warn, fail in tests if (s, t) == (section, table)}
        parts.append(checks.rows(section, tables[table], mine))
    parts += [checks.orphans(s, c, tables[a], tables[b], ka, kb) for s, c, a, ka, b, kb in references]
    for section, check, table, column in unique:
        n = checks.duplicates(tables[table], F.col(column).cast("string"), column).agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(F.lit(section).alias("section"), F.lit(check).alias("check"), checks.status(F.col("n"), 1).alias("status"), F.col("n").cast("string").alias("detail")))
    return checks.report(*parts)


def audit(suite_rows: DataFrame) -> DataFrame:
    """(section, status, n): the verdicts of a suite by section."""
    return suite_rows.groupBy("section", "status").agg(F.count(F.lit(1)).alias("n"))
