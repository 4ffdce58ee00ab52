"""Whole jobs on the test tables: order lines stand for awards, suppliers for funders, customers for people."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..plans import jobs as J
from .joins import TIERS, tier_sides
from .registry import query

_FACTS = """WITH f AS (SELECT o_custkey AS person, s_name AS funder, p_brand AS field, n_name AS place, o_orderpriority AS stage, l_extendedprice AS amount, p_name AS title
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey) """


def facts(t):
    """Awards joined once to their dimensions."""
    c = t.customer.select("c_custkey", "c_nationkey").join(F.broadcast(t.nation.select("n_nationkey", F.col("n_name").alias("place"))), F.col("c_nationkey") == F.col("n_nationkey"))
    l_ = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", F.col("l_extendedprice").alias("amount"))
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("person"), F.col("o_orderpriority").alias("stage"))
    f = l_.join(t.part.select("p_partkey", F.col("p_brand").alias("field"), F.col("p_name").alias("title")), F.col("l_partkey") == F.col("p_partkey"))
    f = f.join(t.supplier.select("s_suppkey", F.col("s_name").alias("funder")), F.col("l_suppkey") == F.col("s_suppkey"))
    return f.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("person") == F.col("c_custkey")).select("person", "funder", "field", "place", "stage", "amount", "title")


@query(_FACTS + "SELECT place, funder, count(*) AS n FROM f GROUP BY 1, 2")
def job_network_matrix(t):
    return J.network(facts(t))["matrix"]


@query(_FACTS + "SELECT person, count(DISTINCT funder) AS funders FROM f GROUP BY person HAVING count(DISTINCT funder) > 1")
def job_network_people(t):
    return J.network(facts(t))["multi_funder"]


@query(_FACTS + ", s AS (SELECT place, count(*) AS n FROM f GROUP BY 1) SELECT round(10000.0::DOUBLE * sum(n * n) / (sum(n) * sum(n)), 6) AS hhi, count(*) AS members, round(max(n)::DOUBLE / sum(n), 6) AS top_share FROM s")
def job_network_concentration(t):
    return J.network(facts(t))["concentration"]


@query(_FACTS + """, n AS (SELECT field, funder, count(*) AS n FROM f GROUP BY 1, 2), s AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, funder) AS k FROM n)
SELECT field, round(1.0::DOUBLE * sum(n * n) / (sum(n) * sum(n)), 6) AS hhi, count(*) AS members, round(max(n)::DOUBLE / sum(n), 6) AS top_share, string_agg(funder, '|' ORDER BY k) FILTER (k <= 3) AS top FROM s GROUP BY field""")
def job_specialisation(t):
    s = J.specialisation(facts(t))
    return s.withColumn("top", F.array_join(F.transform(F.split("top", r"\|"), lambda x: F.split(x, ":")[0]), "|"))


@query(_FACTS + "SELECT field, count(*) AS n, CAST(trunc(median(amount)) AS BIGINT) AS median, CAST(trunc(avg(amount)) AS BIGINT) AS average FROM f WHERE amount > 0 GROUP BY field HAVING count(*) >= 10")
def job_field_medians(t):
    return J.medians_by_field(facts(t), 10)


@query(_FACTS + ", n AS (SELECT field, funder, count(*) AS n FROM f GROUP BY 1, 2) SELECT field, round(10000.0::DOUBLE * sum(n * n) / (sum(n) * sum(n)), 6) AS hhi, count(*) AS members, round(max(n)::DOUBLE / sum(n), 6) AS top_share, sum(n)::BIGINT AS n, max(n)::DOUBLE / sum(n) > 0.5 AS dependent FROM n GROUP BY field HAVING sum(n) >= 20")
def job_vulnerability(t):
    return J.vulnerability(facts(t), 20)


@query(_FACTS + ", p AS (SELECT p_brand AS field, count(*) AS n FROM part GROUP BY 1), g AS (SELECT field, count(DISTINCT person) AS funded FROM f GROUP BY 1) SELECT p.field, p.n, coalesce(funded, 0) AS funded, round(100.0::DOUBLE * coalesce(funded, 0) / p.n, 4) AS coverage FROM p LEFT JOIN g USING (field)")
def job_strata(t):
    population = t.part.groupBy(F.col("p_brand").alias("field")).agg(F.count(F.lit(1)).alias("n"))
    return J.strata(facts(t), population)


@query("""WITH a AS (SELECT c_nationkey AS key, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS key, count(*) AS n FROM supplier WHERE s_acctbal > 0 GROUP BY 1), r AS (SELECT s_nationkey AS key, round(avg(s_acctbal) / 4000, 4) AS ratio FROM supplier GROUP BY 1),
d AS (SELECT coalesce(a.key, b.key) AS key, coalesce(a.n, 0) AS policy, coalesce(b.n, 0) AS industry FROM a FULL JOIN b ON a.key = b.key), m AS (SELECT coalesce(d.key, r.key) AS key, coalesce(policy, 0) AS policy, coalesce(industry, 0) AS industry, coalesce(policy, 0) + coalesce(industry, 0) AS demand, ratio FROM d FULL JOIN r ON d.key = r.key),
k AS (SELECT *, row_number() OVER (ORDER BY demand DESC, key) AS place FROM m)
SELECT key, policy, industry, demand, ratio, place, CASE WHEN place <= 22 AND (ratio IS NULL OR ratio < 0.8) THEN 'under' WHEN ratio > 1.3 THEN 'over' END AS verdict FROM k""")
def job_demand_supply(t):
    count = lambda df, k: df.groupBy(F.col(k).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    ratio = t.supplier.groupBy(F.col("s_nationkey").alias("key")).agg(F.round(F.avg("s_acctbal") / 4000, 4).alias("ratio"))
    return J.demand_and_supply({"policy": count(t.customer, "c_nationkey"), "industry": count(t.supplier.filter("s_acctbal > 0"), "s_nationkey")}, ratio)


@query(_FACTS + """SELECT CASE WHEN contains(title, 'ring') THEN 'one' WHEN contains(title, 'gear') THEN 'two' ELSE 'rest' END AS theme, CASE WHEN place IN ('NATION_1', 'NATION_2') THEN 'elite' ELSE 'other' END AS tier, CASE WHEN stage IN ('1-URGENT', '2-HIGH') THEN 'early' ELSE 'later' END AS career, count(*) AS n FROM f GROUP BY ALL ORDER BY n DESC, theme, tier, career LIMIT 20""")
def job_cross_cells(t):
    theme = R.first_match(F.col("title"), [R.Rule("one", ("ring",)), R.Rule("two", ("gear",))], "rest")
    tier = F.when(F.col("place").isin("NATION_1", "NATION_2"), "elite").otherwise("other")
    return J.cross_cells(facts(t), theme, tier, F.col("stage").isin("1-URGENT", "2-HIGH"))


@query("""WITH a AS (SELECT c_mktsegment AS k, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY 1), b AS (SELECT c_mktsegment AS k, count(*) AS n FROM customer GROUP BY 1),
x AS (SELECT k, 100 * round(n::DOUBLE / sum(n) OVER (), 8) AS p FROM a), y AS (SELECT k, 100 * round(n::DOUBLE / sum(n) OVER (), 8) AS p FROM b)
SELECT coalesce(x.k, y.k) AS segment, round(coalesce(x.p, 0), 4) AS a_pct, round(coalesce(y.p, 0), 4) AS b_pct, round(coalesce(x.p, 0) - coalesce(y.p, 0), 4) AS gap FROM x FULL JOIN y ON x.k = y.k""")
def job_tier_additionality(t):
    count = lambda df: df.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return J.tier_additionality(count(t.customer.filter("c_acctbal > 5000")), count(t.customer), "segment")


@query(_FACTS + "SELECT field, count(*) AS n, count(*) FILTER (amount < 30000) AS small, count(*) FILTER (amount >= 60000) AS large, count(DISTINCT CASE WHEN amount >= 60000 THEN funder END) AS large_funders FROM f GROUP BY field")
def job_landscape(t):
    return J.landscape(facts(t), 30000, 60000)


@query("""WITH s AS (SELECT event_type AS code, count(*) * 0.3::DOUBLE + count(*) FILTER (value > 90) * 2.0::DOUBLE + count(*) FILTER (value > 50) * 0.5::DOUBLE + count(DISTINCT user_id) * 1.5::DOUBLE AS score, sum(value) AS money FROM events GROUP BY 1),
m AS (SELECT code, score, round(100.0 * money / sum(money) OVER (), 2) AS share FROM s)
SELECT code, round(100 * ln(1 + score) / max(ln(1 + score)) OVER (), 1) AS score_norm, round(100 * ln(1 + share) / max(ln(1 + share)) OVER (), 1) AS grant_rounded, round(round(100 * ln(1 + score) / max(ln(1 + score)) OVER (), 1) - 100 * ln(1 + share) / max(ln(1 + share)) OVER (), 1) AS gap FROM m""")
def job_foresight(t):
    e = t.events.groupBy(F.col("event_type").alias("code")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("value") > 90).alias("high"), F.count_if(F.col("value") > 50).alias("medium"), F.countDistinct("user_id").alias("mentions"), F.sum("value").alias("money"))
    from ..operators import aggregates as A

    scores = e.withColumn("score", J.importance(e)).select("code", "score")
    shares = e.select("code", F.round(100.0 * F.col("money") / F.sum("money").over(A.every()), 2).alias("share"))
    return J.foresight(scores, shares)


@query(TIERS + "SELECT method, count(*) AS matched, confidence FROM m GROUP BY method, confidence")
def job_integration(t):
    return J.integration(*tier_sides(t), ["h1"])[1]


@query("""WITH r AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9000) SELECT (SELECT count(*) FROM supplier WHERE s_nationkey IN (SELECT k FROM r)) AS verified, (SELECT count(*) FROM r WHERE k NOT IN (SELECT s_nationkey FROM supplier)) AS missing, (SELECT count(*) FROM supplier) AS total""")
def job_grounding(t):
    orgs = t.supplier.select(F.col("s_nationkey").alias("k"))
    return J.grounding(orgs, t.customer.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"), "c_custkey"), "k", [F.col("c_custkey")])


@query("""WITH b AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY (c_acctbal > 5000)::INT + (c_acctbal > 0)::INT DESC, c_custkey) AS k, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS rank FROM customer), t AS (SELECT * FROM b WHERE k = 1 ORDER BY coalesce(rank, 9999), c_name, c_custkey LIMIT 30)
SELECT c_custkey AS id, row_number() OVER (ORDER BY coalesce(rank, 9999), c_name, c_custkey) AS place FROM t""")
def job_inventory(t):
    c = F.col
    orgs = t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), F.when(c("c_custkey") % 3 == 0, c("c_custkey")).alias("rank"), "c_nationkey", "c_mktsegment", "c_acctbal")
    rich = (c("c_acctbal") > 5000).cast("int") + (c("c_acctbal") > 0).cast("int")
    return J.inventory(orgs, F.concat_ws("|", c("c_nationkey").cast("string"), "c_mktsegment"), rich, 30).select("id", F.col("place").cast("long").alias("place"))


@query("""SELECT (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 0) AS new, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0) AS known""")
def job_import_plan(t):
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return J.imported(c.filter("id % 3 <> 0"), c.filter("id % 2 = 0"), "id", ["segment"])[1]


@query(_FACTS + """SELECT via, fine, count(*) AS n FROM (SELECT CASE WHEN field = 'Brand#1' THEN 'first' WHEN contains(title, 'bolt') THEN 'seven' ELSE 'unclassified' END AS fine, CASE WHEN field = 'Brand#1' THEN 'field' WHEN contains(title, 'bolt') THEN 'theme' ELSE 'none' END AS via FROM f) GROUP BY 1, 2""")
def job_hybrid_fields(t):
    authority = t.spark.createDataFrame([("Brand#1", "first")], "field string, mapped string")
    return J.hybrid_fields(facts(t), authority, [R.Rule("seven", ("bolt",))], "unclassified").groupBy("via", "fine").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT n_name AS l2, r_name AS l1, c_acctbal AS a FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), x AS (SELECT l1, l2, count(*) AS n, sum(CASE WHEN a BETWEEN 0 AND 9000 THEN a ELSE 0 END) AS total FROM m GROUP BY 1, 2)
SELECT l1, l2, 2 AS depth, n, round(total, 2) AS total FROM x UNION ALL SELECT l1, NULL, 1, sum(n)::BIGINT, round(sum(total), 2) FROM x GROUP BY l1""")
def job_field_tree(t):
    m = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("l1"), F.col("n_name").alias("l2"), "c_acctbal")
    return J.field_tree(m, ["l1", "l2"], "c_acctbal", 9000).withColumn("total", F.round("total", 2))


@query("""SELECT method, count(*) AS n FROM (WITH p AS (SELECT c_custkey AS pid, 'n' || (c_custkey % 97) AS name, 'nation' || c_nationkey AS inst FROM customer), x AS (SELECT s_suppkey AS xid, 'n' || (s_suppkey % 89) AS name, 'nation' || s_nationkey AS inst FROM supplier),
c AS (SELECT pid, xid, count(*) OVER (PARTITION BY pid) AS n, p.inst = x.inst AS ok FROM p JOIN x USING (name)), d AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY pid) AS agreeing FROM c)
SELECT CASE WHEN n = 1 THEN 'unique' ELSE 'institution' END AS method FROM d WHERE n = 1 OR (ok AND agreeing = 1)) GROUP BY 1""")
def job_linkage_bias(t):
    name = lambda c, n: F.concat(F.lit("n"), (F.col(c) % n).cast("string")).alias("name")
    inst = lambda c: F.concat(F.lit("nation"), F.col(c).cast("string"), F.lit("$")).alias("inst")
    p = t.customer.select(F.col("c_custkey").alias("pid"), name("c_custkey", 97), inst("c_nationkey"))
    x = t.supplier.select(F.col("s_suppkey").alias("xid"), name("s_suppkey", 89), inst("s_nationkey"))
    return J.linkage_bias(p, x).select("method", "n")


@query("""WITH p AS (SELECT p_partkey AS id, p_brand AS organization_id FROM part), o AS (SELECT DISTINCT p_brand AS id FROM part), w AS (SELECT id FROM o WHERE id LIKE '%1%')
SELECT (SELECT count(*) FROM w) AS organizations, (SELECT count(*) FROM p WHERE organization_id IN (SELECT id FROM w)) AS programs, (SELECT count(*) FROM lineitem WHERE l_partkey IN (SELECT id FROM p WHERE organization_id IN (SELECT id FROM w))) AS calls""")
def job_focused(t):
    orgs = t.part.select(F.col("p_brand").alias("id")).distinct()
    programs = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("organization_id"))
    parts = J.focused(orgs, programs, t.lineitem.select(F.col("l_partkey").alias("program_id")), F.contains("id", F.lit("1")))
    one = lambda name, k: parts[k].agg(F.count(F.lit(1)).alias(name))
    return one("organizations", "organizations").crossJoin(one("programs", "grant_programs")).crossJoin(one("calls", "grant_calls"))
