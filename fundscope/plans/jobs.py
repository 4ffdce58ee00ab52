"""Analytic jobs over awards: frames (person, funder, field, place, stage, amount) composed of the operators.

A job is a function of DataFrames; it collects nothing.  Facts are read once per result frame; cache them where a caller
asks for three or more results of the same facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import matching as M
from ..operators import merging as U
from ..operators import rules as R
from ..operators import windows as W


def focused(orgs: DataFrame, programs: DataFrame, calls: DataFrame, wanted: Column) -> dict[str, DataFrame]:
    """The part of the star below the organisations that a predicate picks, by semi-joins instead of id lists."""
    o = orgs.filter(wanted)
    p = programs.join(o.select(F.col("id").alias("organization_id")), "organization_id", "left_semi")
    c = calls.join(p.select(F.col("id").alias("program_id")), "program_id", "left_semi")
    return {"organizations": o, "grant_programs": p, "grant_calls": c}


def field_tree(matches: DataFrame, levels: Sequence[str], amount: str, most: float) -> DataFrame:
    """Counts and amounts per node of a rule hierarchy; parents add up children, so a row under two counts twice."""
    leaf = matches.groupBy(*levels).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col(amount).between(0, most), F.col(amount)).otherwise(0)).alias("total"))
    return A.rolled_up(leaf, list(levels), ["n", "total"])


def network(facts: DataFrame) -> dict[str, DataFrame]:
    """Concentration of places, the matrix place x funder in long form, and people with several funders."""
    places = facts.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    return {
        "concentration": A.hhi(places),
        "matrix": facts.groupBy("place", "funder").agg(F.count(F.lit(1)).alias("n")),
        "multi_funder": facts.select("person", "funder").distinct().groupBy("person").agg(F.count(F.lit(1)).alias("funders")).filter("funders > 1"),
    }


def specialisation(facts: DataFrame, top: int = 3) -> DataFrame:
    """Per field: awards, funders, their concentration (0 to 1) and the largest funders with shares."""
    n = facts.groupBy("field", "funder").agg(F.count(F.lit(1)).alias("n"))
    first = A.top_k(A.with_share(n, "n", ["field"], 4), ["field"], [F.desc("n"), F.col("funder")], top)
    names = first.groupBy("field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "funder", "share"))), lambda x: F.concat(x["funder"], F.lit(":"), x["share"].cast("string"))), "|").alias("top"))
    return A.hhi(n, by=["field"], scale=1.0).join(names, "field")


def medians_by_field(facts: DataFrame, least: int = 10) -> DataFrame:
    paid = facts.filter("amount > 0")
    return paid.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.median("amount").cast("long").alias("median"), F.avg("amount").cast("long").alias("average")).filter(F.col("n") >= least)


def vulnerability(facts: DataFrame, least: int) -> DataFrame:
    """Per field: awards, concentration over funders, and whether one funder gives more than half."""
    n = facts.groupBy("field", "funder").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("field").agg(F.sum("n").alias("n"))
    return A.hhi(n, by=["field"]).join(total, "field").filter(F.col("n") >= least).withColumn("dependent", F.col("top_share") > 0.5)


def strata(facts: DataFrame, population: DataFrame) -> DataFrame:
    """Per field: people funded, people there are, and coverage in percent."""
    funded = facts.select("field", "person").distinct().groupBy("field").agg(F.count(F.lit(1)).alias("funded"))
    return population.join(funded, "field", "left").select("field", "n", F.coalesce("funded", F.lit(0)).alias("funded"), F.round(F.try_divide(100.0 * F.coalesce("funded", F.lit(0)), F.col("n")), 4).alias("coverage"))


def demand_and_supply(demand: dict[str, DataFrame], supply: DataFrame, top: int = 22, under: float = 0.8, over: float = 1.3) -> DataFrame:
    """Keys by total demand; under-served ones among the ``top``, over-served ones anywhere.  ``supply``: key, ratio."""
    d = A.zero_filled_union(demand, "key")
    d = d.withColumn("demand", sum(F.col(x) for x in demand))
    all_ = d.join(supply, "key", "full_outer").na.fill(0, [*demand, "demand"])
    place = F.row_number().over(Window.orderBy(F.desc("demand"), "key"))
    ranked = all_.withColumn("place", place)
    verdict = F.when((F.col("place") <= top) & (F.col("ratio").isNull() | (F.col("ratio") < under)), "under").when(F.col("ratio") > over, "over")
    return ranked.withColumn("verdict", verdict)


def cross_cells(facts: DataFrame, theme: Column, tier: Column, early: Column, top: int = 20) -> DataFrame:
    """The commonest cells of theme x tier x career stage."""
    stage = F.when(early.isNull(), "unknown").when(early, "early").otherwise("later")
    return facts.groupBy(theme.alias("theme"), tier.alias("tier"), stage.alias("career")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "theme", "tier", "career").limit(top)


def tier_additionality(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Shares in percent of two distributions and their gap, unknown ones aside."""
    x, y = (A.with_share(df.filter(F.col(key).isNotNull()), "n", digits=8).select(key, (100 * F.col("share")).alias(s)) for df, s in ((a, "a"), (b, "b")))
    return x.join(y, key, "full_outer").select(key, F.round(F.coalesce("a", F.lit(0.0)), 4).alias("a_pct"), F.round(F.coalesce("b", F.lit(0.0)), 4).alias("b_pct"), F.round(F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0)), 4).alias("gap"))


def landscape(facts: DataFrame, small: float, large: float) -> DataFrame:
    return facts.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("amount") < small).alias("small"), F.count_if(F.col("amount") >= large).alias("large"), F.countDistinct(F.when(F.col("amount") >= large, F.col("funder"))).alias("large_funders"))


def linkage_bias(people: DataFrame, index: DataFrame, k: int = 15) -> DataFrame:
    """Rows linked by homonym resolution: how many, by which method, and the top places' share of them."""
    linked = M.homonyms(people, index, prefix=12)
    by = linked.groupBy("method").agg(F.count(F.lit(1)).alias("n"))
    places = linked.join(people, "pid").groupBy("inst").agg(F.count(F.lit(1)).alias("n"))
    return by.crossJoin(A.top_share(places, "n", [F.desc("n"), F.col("inst")], k).select("share"))


def foresight(scores: DataFrame, shares: DataFrame) -> DataFrame:
    """(code, score_norm, grant_norm, gap): importance against the share of money, both on logarithmic scales of 100.

    Shares are rounded to two places before the logarithm; the gap uses the unrounded share scale.
    """
    s = F.log1p("score")
    a = scores.withColumn("score_norm", F.round(100 * s / F.nullif(F.max(s).over(A.every()), F.lit(0.0)), 1))
    b = A.log_score(shares, "share", "grant_norm")
    return a.join(b, "code", "left").select("code", "score_norm", F.round(F.coalesce("grant_norm", F.lit(0.0)), 1).alias("grant_rounded"), F.round(F.col("score_norm") - F.coalesce("grant_norm", F.lit(0.0)), 1).alias("gap"))


def importance(df: DataFrame) -> Column:
    """Predictions, confident ones, and scenario mentions, weighted."""
    return df["total"] * 0.3 + df["high"] * 2.0 + df["medium"] * 0.5 + df["mentions"] * 1.5


def integration(left: DataFrame, right: DataFrame, aggregators: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(mapping, one row of counts per method) of a one-to-one match of two sources."""
    mapping = M.tiered(left, right, aggregators)
    return mapping, mapping.groupBy("method").agg(F.count(F.lit(1)).alias("matched"), F.round(F.avg("confidence"), 4).alias("confidence"))


def grounding(orgs: DataFrame, registry: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Dry run: how many organisations a registry confirms by key, and how many of its entries are missing."""
    first = W.first_per_key(registry, [key], order)
    hit = orgs.join(first, key, "left_semi").agg(F.count(F.lit(1)).alias("verified"))
    missing = first.join(orgs, key, "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    return hit.crossJoin(missing).crossJoin(orgs.agg(F.count(F.lit(1)).alias("total")))


def inventory(orgs: DataFrame, key: Column, richness: Column, take: int) -> DataFrame:
    """The richest row of each name, by rank (unknown ranks last), numbered; at most ``take``."""
    best = W.first_per_key(orgs.withColumn("_key", key), ["_key"], [F.desc(richness), F.col("id")]).drop("_key")
    top = best.orderBy(F.coalesce("rank", F.lit(9999)), "name", "id").limit(take)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.coalesce("rank", F.lit(9999)), "name", "id")))


def imported(current: DataFrame, incoming: DataFrame, key: str, fill: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(table, plan): known entities get their blanks filled, unknown ones are added, with counts of both."""
    filled = U.fill_blanks(current, incoming, key, list(fill))
    new = incoming.join(current, key, "left_anti")
    plan = new.agg(F.count(F.lit(1)).alias("new")).crossJoin(incoming.join(current, key, "left_semi").agg(F.count(F.lit(1)).alias("known")))
    return filled.unionByName(new, allowMissingColumns=True), plan


def hybrid_fields(facts: DataFrame, authority: DataFrame, rules: Sequence[R.Rule], default: str) -> DataFrame:
    """Field from the authority's map, else from the title's theme, else ``default``, with where it came from."""
    theme = R.first_match(F.col("title"), rules)
    j = facts.join(F.broadcast(authority), "field", "left")
    return j.withColumns({"fine": F.coalesce("mapped", theme, F.lit(default)), "via": F.when(F.col("mapped").isNotNull(), "field").when(theme.isNotNull(), "theme").otherwise("none")})
