"""Joins, semi and anti joins, and entity matching on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching as M
from ..operators import windows
from .registry import query


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def semi(t):
    return t.customer.join(t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 300000)")
def anti(t):
    return t.customer.join(t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' WHERE o_orderkey IS NULL")
def null_anti(t):
    return t.customer.join(t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT count(*) AS plain, (SELECT count(*) FROM nation WHERE n_nationkey NOT IN (SELECT nullif(s_nationkey, 3) FROM supplier)) AS poisoned FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)")
def not_in(t):
    t.nation.createOrReplaceTempView("fs_nation")
    t.supplier.createOrReplaceTempView("fs_supplier")
    one = t.spark.sql("SELECT count(*) AS plain FROM fs_nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM fs_supplier WHERE s_acctbal > 8000)")
    # one NULL in the list makes every NOT IN unknown
    two = t.spark.sql("SELECT count(*) AS poisoned FROM fs_nation WHERE n_nationkey NOT IN (SELECT nullif(s_nationkey, 3) FROM fs_supplier)")
    return one.crossJoin(two)


@query("""SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey LIMIT 1) AS latest FROM customer""")
def corr_scalar(t):
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max_by("o_orderkey", F.struct("o_orderdate", -F.col("o_orderkey"))).alias("latest"))
    return t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), "latest")


@query("""WITH k AS (SELECT * FROM (VALUES (1, 'red'), (2, 'blue'), (3, 'green'), (4, 'ring'), (5, 'zz')) v(kid, word))
SELECT kid, word, count(p_partkey) AS n, min(p_partkey) AS first FROM k LEFT JOIN part ON contains(lower(p_name), word) GROUP BY kid, word""")
def theta_contains(t):
    # the key list is given data: its pairs with the parts come from one pass that tests every key
    keys = [(1, "red"), (2, "blue"), (3, "green"), (4, "ring"), (5, "zz")]
    hit = F.array_compact(F.array(*[F.when(F.contains(F.lower("p_name"), F.lit(w)), k) for k, w in keys]))
    found = t.part.select("p_partkey", F.explode(hit).alias("kid")).groupBy("kid").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))
    return F.broadcast(t.spark.createDataFrame(keys, "kid int, word string")).join(found, "kid", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name = 'ASIA'")
def left_on_pred(t):
    return t.nation.join(F.broadcast(t.region), (F.col("n_regionkey") == F.col("r_regionkey")) & (F.col("r_name") == "ASIA"), "left").select("n_name", "r_name")


@query("""WITH b AS (SELECT DISTINCT p_brand, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT x.p_brand AS brand, y.p_brand AS other, count(*) AS suppliers FROM b x JOIN b y ON x.l_suppkey = y.l_suppkey AND x.p_brand <> y.p_brand GROUP BY 1, 2""")
def bridge_m2m(t):
    b = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("brand"), "l_suppkey").distinct()
    o = b.select(F.col("brand").alias("other"), "l_suppkey")
    return b.join(o, "l_suppkey").filter("brand <> other").groupBy("brand", "other").agg(F.count(F.lit(1)).alias("suppliers"))


@query("""SELECT n_name AS name, 'supplied' AS kind FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000) UNION ALL
SELECT n_name, 'other' FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000) AND n_regionkey IS NOT NULL""")
def union_missing(t):
    s = t.supplier.filter("s_acctbal > 7000").select(F.col("s_nationkey").alias("n_nationkey"))
    n = t.nation
    have = n.join(s, "n_nationkey", "left_semi").select(F.col("n_name").alias("name"), F.lit("supplied").alias("kind"))
    rest = n.join(s, "n_nationkey", "left_anti").filter("n_regionkey is not null").select(F.col("n_name").alias("name"), F.lit("other").alias("kind"))
    return have.unionByName(rest)


@query("""WITH f AS (SELECT c_nationkey AS k, min(c_custkey) AS first, max(c_custkey) AS last FROM customer GROUP BY 1) SELECT s_suppkey, first, last FROM supplier LEFT JOIN f ON s_nationkey = k""")
def first_and_last_wins(t):
    c = t.customer.select(F.col("c_nationkey").alias("s_nationkey"), "c_custkey")
    first = M.keyed(t.supplier, c.withColumnRenamed("c_custkey", "first"), "s_nationkey", [F.col("first")])
    return M.keyed(first, c.withColumnRenamed("c_custkey", "last"), "s_nationkey", [F.desc("last")]).select("s_suppkey", "first", "last")


@query("""SELECT p_partkey, CASE WHEN p_size < 5 THEN 'tiny' WHEN p_size < 10 THEN 'small' ELSE 'other' END AS label FROM part""")
def dim_map_default(t):
    dim = t.spark.createDataFrame([(k, "tiny" if k < 5 else "small") for k in range(10)], "p_size int, label string")
    return t.part.join(F.broadcast(dim), "p_size", "left").select("p_partkey", F.coalesce("label", F.lit("other")).alias("label"))


@query("""SELECT k.id, k.name FROM (SELECT s_suppkey + 900000000 AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer) k WHERE k.id IN (SELECT CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey + 900000000 ELSE l_suppkey END FROM lineitem)""")
def routed_ids(t):
    both = t.supplier.select((F.col("s_suppkey") + 900_000_000).alias("id"), F.col("s_name").alias("name")).unionByName(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    asked = t.lineitem.select(F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey") + 900_000_000).otherwise(F.col("l_suppkey")).alias("id"))
    return both.join(asked, "id", "left_semi")


#: Customers against suppliers: some share a name, most a host, and some names lie within a supplier's.
TIERS = """WITH l AS (SELECT c_custkey AS lid, CASE WHEN c_custkey % 11 = 0 THEN '#' || lpad(CAST(c_custkey // 11 AS VARCHAR), 9, '0') ELSE lower(c_mktsegment) END AS name, 'h' || c_nationkey AS host FROM customer),
r AS (SELECT s_suppkey AS rid, CASE WHEN s_suppkey % 10 = 0 THEN 'building' ELSE s_name END AS name, 'h' || s_nationkey AS host FROM supplier),
t1 AS (SELECT lid, rid FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY lid) AS k FROM l) a JOIN (SELECT *, row_number() OVER (PARTITION BY name ORDER BY rid) AS k FROM r) b USING (name, k)),
l2 AS (SELECT * FROM l WHERE lid NOT IN (SELECT lid FROM t1)), r2 AS (SELECT * FROM r WHERE rid NOT IN (SELECT rid FROM t1)),
t2 AS (SELECT lid, rid FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY lid) AS k FROM l2 WHERE host <> 'h1') a JOIN (SELECT *, row_number() OVER (PARTITION BY host ORDER BY rid) AS k FROM r2 WHERE host <> 'h1') b USING (host, k)),
l3 AS (SELECT * FROM l2 WHERE lid NOT IN (SELECT lid FROM t2)), r3 AS (SELECT * FROM r2 WHERE rid NOT IN (SELECT rid FROM t2)),
c AS (SELECT lid, min(rid) AS rid FROM l3 a JOIN r3 b ON (length(a.name) >= 4 AND contains(b.name, a.name)) OR (length(b.name) >= 4 AND contains(a.name, b.name)) GROUP BY lid),
t3 AS (SELECT min(lid) AS lid, rid FROM c GROUP BY rid),
m AS (SELECT lid, rid, 'name' AS method, 0.95::DOUBLE AS confidence FROM t1 UNION ALL SELECT lid, rid, 'host', 0.85::DOUBLE FROM t2 UNION ALL SELECT lid, rid, 'contains', 0.70::DOUBLE FROM t3) """


def tier_sides(t):
    lower, number = F.lower("c_mktsegment"), F.lpad(F.floor(F.col("c_custkey") / 11).cast("string"), 9, "0")
    l_ = t.customer.select(F.col("c_custkey").alias("lid"), F.when(F.col("c_custkey") % 11 == 0, F.concat(F.lit("#"), number)).otherwise(lower).alias("name"), F.concat(F.lit("h"), F.col("c_nationkey").cast("string")).alias("host"))
    r = t.supplier.select(F.col("s_suppkey").alias("rid"), F.when(F.col("s_suppkey") % 10 == 0, "building").otherwise(F.col("s_name")).alias("name"), F.concat(F.lit("h"), F.col("s_nationkey").cast("string")).alias("host"))
    return l_, r


@query(TIERS + "SELECT * FROM m")
def match_tier(t):
    return M.tiered(*tier_sides(t), ["h1"])


@query("""WITH p AS (SELECT c_custkey AS pid, 'n' || (c_custkey % 97) AS name, 'nation' || c_nationkey AS inst FROM customer), x AS (SELECT s_suppkey AS xid, 'n' || (s_suppkey % 89) AS name, 'nation' || s_nationkey AS inst FROM supplier),
c AS (SELECT pid, xid, count(*) OVER (PARTITION BY pid) AS n, p.inst = x.inst AS ok FROM p JOIN x USING (name)),
d AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY pid) AS agreeing FROM c)
SELECT pid, xid, CASE WHEN n = 1 THEN 'unique' ELSE 'institution' END AS method FROM d WHERE n = 1 OR (ok AND agreeing = 1)""")
def match_homonym(t):
    name = lambda c, n: F.concat(F.lit("n"), (F.col(c) % n).cast("string")).alias("name")
    inst = lambda c: F.concat(F.lit("nation"), F.col(c).cast("string"), F.lit("$")).alias("inst")
    p = t.customer.select(F.col("c_custkey").alias("pid"), name("c_custkey", 97), inst("c_nationkey"))
    x = t.supplier.select(F.col("s_suppkey").alias("xid"), name("s_suppkey", 89), inst("s_nationkey"))
    return M.homonyms(p, x, prefix=12)


@query("""WITH p AS (SELECT c_custkey AS pid, c_custkey % 60 AS name, c_nationkey AS tok FROM customer), x AS (SELECT s_suppkey AS xid, s_suppkey % 80 AS name, s_nationkey AS tok, count(*) OVER (PARTITION BY s_suppkey % 80) AS h FROM supplier),
c AS (SELECT pid, xid, h, p.tok = x.tok AS o, count(*) OVER (PARTITION BY pid) AS n FROM p JOIN x USING (name)), d AS (SELECT *, count(*) FILTER (o) OVER (PARTITION BY pid) AS k FROM c)
SELECT pid, xid, CASE WHEN n = 1 AND h = 1 THEN 'unique_name' ELSE 'institution_token' END AS method FROM d WHERE (n = 1 AND h = 1) OR (o AND k = 1)""")
def match_conservative(t):
    from pyspark.sql import Window

    tok = lambda c: F.array(F.col(c).cast("string")).alias("tokens")
    p = t.customer.select(F.col("c_custkey").alias("pid"), (F.col("c_custkey") % 60).alias("name"), tok("c_nationkey"))
    x = t.supplier.select(F.col("s_suppkey").alias("xid"), (F.col("s_suppkey") % 80).alias("name"), tok("s_nationkey")).withColumn("homonyms", F.count(F.lit(1)).over(Window.partitionBy("name")))
    return M.conservative(p, x)


@query("""WITH e AS (SELECT c_custkey AS eid, c_custkey % 70 AS key, c_nationkey AS a FROM customer), r AS (SELECT s_suppkey AS rid, s_suppkey % 70 AS key, s_nationkey AS b FROM supplier),
c AS (SELECT eid, rid, a, b, count(*) OVER (PARTITION BY eid) AS n FROM e JOIN r USING (key)),
d AS (SELECT *, count(*) FILTER (a = b) OVER (PARTITION BY eid) AS s1, count(*) FILTER (a % 5 = b % 5) OVER (PARTITION BY eid) AS s2 FROM c),
w AS (SELECT eid, rid, CASE WHEN n = 1 THEN 0 WHEN a = b AND s1 = 1 THEN 1 WHEN a % 5 = b % 5 AND s2 = 1 THEN 2 END AS o FROM d),
f AS (SELECT eid, rid, o, row_number() OVER (PARTITION BY eid ORDER BY o, rid) AS k FROM w WHERE o IS NOT NULL)
SELECT e.eid, f.rid, CASE f.o WHEN 0 THEN 'single' WHEN 1 THEN 'exact' WHEN 2 THEN 'loose' ELSE CASE WHEN e.eid IN (SELECT eid FROM c) THEN 'unresolved' ELSE 'none' END END AS rule FROM e LEFT JOIN f ON e.eid = f.eid AND k = 1""")
def match_disambiguated(t):
    e = t.customer.select(F.col("c_custkey").alias("eid"), (F.col("c_custkey") % 70).alias("key"), F.col("c_nationkey").alias("a"))
    r = t.supplier.select(F.col("s_suppkey").alias("rid"), (F.col("s_suppkey") % 70).alias("key"), F.col("s_nationkey").alias("b"))
    return M.disambiguated(e, r, [("exact", F.col("a") == F.col("b")), ("loose", F.col("a") % 5 == F.col("b") % 5)])


_FUZZY = """WITH x AS (SELECT s_suppkey AS xid, lower(substring(s_name, 1, 12)) || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'zz' END AS a FROM supplier), t AS (SELECT s_suppkey AS tid, lower(s_name) AS b FROM supplier),
c AS (SELECT xid, tid, CASE WHEN a = b THEN 'equal' WHEN length(a) >= 4 AND contains(b, a) OR length(b) >= 4 AND contains(a, b) THEN 'contains' ELSE 'prefix' END AS kind FROM x JOIN t ON a = b OR (length(a) >= 4 AND contains(b, a)) OR (length(b) >= 4 AND contains(a, b)) OR (length(a) >= 5 AND contains(b, substring(a, 1, 5))))
SELECT xid, tid, kind FROM (SELECT *, row_number() OVER (PARTITION BY xid ORDER BY tid) AS k FROM c) WHERE k = 1"""


@query(_FUZZY)
def match_fuzzy(t):
    external = t.supplier
    tail = F.when(F.col("s_suppkey") % 3 == 0, "").otherwise("zz")
    x = external.select(F.col("s_suppkey").alias("xid"), F.concat(F.lower(F.substring("s_name", 1, 12)), tail).alias("name"))
    return M.fuzzy_first(x, t.supplier.select(F.col("s_suppkey").alias("tid"), F.lower("s_name").alias("name")))


@query()
def match_loose(t):
    """Exact keys first, containment for the rest; greedy, so rows only here and a unit test for the pairs."""
    name = F.lower("s_name")
    s = t.supplier.select(F.col("s_suppkey").alias("sid"), F.when(F.col("s_suppkey") % 2 == 0, name).otherwise(F.substring(name, 9, 20)).alias("key"))
    return M.loose_fallback(s, t.supplier.select(F.col("s_suppkey").alias("tid"), F.lower("s_name").alias("key")))


@query("""WITH n AS (SELECT substring(md5(CAST(p_partkey AS VARCHAR)), 1, 10) AS name FROM part WHERE p_partkey % 2 = 0), o AS (SELECT DISTINCT CASE WHEN p_partkey % 9 = 0 THEN substring(md5(CAST(p_partkey AS VARCHAR)), 1, 7) ELSE substring(md5(CAST(p_partkey AS VARCHAR)), 3, 6) END AS name FROM part WHERE p_partkey % 3 = 0)
SELECT name FROM n WHERE substring(name, 1, 6) NOT IN (SELECT substring(name, 1, 6) FROM o) AND NOT EXISTS (SELECT 1 FROM o WHERE contains(n.name, o.name) OR contains(o.name, n.name))""")
def match_prefix(t):
    h = F.md5(F.col("p_partkey").cast("string").cast("binary"))
    old = F.when(F.col("p_partkey") % 9 == 0, F.substring(h, 1, 7)).otherwise(F.substring(h, 3, 6))
    return M.not_prefix_duplicates(t.part.filter("p_partkey % 2 = 0").select(F.substring(h, 1, 10).alias("name")), t.part.filter("p_partkey % 3 = 0").select(old.alias("name")).distinct())


@query("""WITH p AS (SELECT p_partkey, p_name, CASE WHEN contains(lower(p_name), 'qqq') THEN 0 WHEN contains(lower(p_name), 'widget') THEN 1 WHEN contains(lower(p_name), 'bolt') THEN 2 END AS k FROM part)
SELECT p_partkey, p_name FROM p WHERE k IS NOT NULL ORDER BY k, length(p_name), p_partkey LIMIT 1""")
def pattern_lookup(t):
    return M.pattern_lookup(t.part, ["qqq", "widget", "bolt"], name="p_name", key="p_partkey").select("p_partkey", "p_name")


@query("""WITH c AS (SELECT doc_id, item_id, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(b.text = d.text, false) DESC, item_id) AS k FROM documents d JOIN benchmark b ON lower(substring(d.text, 1, 2)) = lower(substring(b.text, 1, 2)))
SELECT doc_id, item_id FROM c WHERE k = 1""")
def composite_key_tiebreak(t):
    """Among items of one key the equal text wins, then the lowest id."""
    key = F.lower(F.substring("text", 1, 2)).alias("key")
    d, b = t.documents.select("doc_id", key, F.col("text").alias("dt")), t.benchmark.select("item_id", key, F.col("text").alias("bt"))
    same = F.coalesce(F.col("dt") == F.col("bt"), F.lit(False))
    ranked = d.join(F.broadcast(b), "key").select("doc_id", "item_id", same.alias("same"))
    return windows.first_per_key(ranked, ["doc_id"], [F.desc("same"), F.col("item_id")]).select("doc_id", "item_id")


@query("""SELECT a.c_custkey FROM customer a JOIN supplier s ON nullif(a.c_nationkey, 3) IS NOT DISTINCT FROM nullif(s.s_nationkey, 3)""")
def null_safe_join(t):
    s = t.supplier.select(F.nullif("s_nationkey", F.lit(3)).alias("k"))
    c = t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("k"))
    return M.repeated_per_match(c, s, "k").select("c_custkey")


@query("""WITH c AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) SELECT n_name, c.n AS customers, s.n AS suppliers FROM nation JOIN c ON n_nationkey = c.k JOIN s ON n_nationkey = s.k WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA')""")
def chain_join(t):
    count = lambda df, k, name: df.groupBy(F.col(k).alias("n_nationkey")).agg(F.count(F.lit(1)).alias(name))
    n = t.nation.join(F.broadcast(t.region.filter("r_name <> 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.join(count(t.customer, "c_nationkey", "customers"), "n_nationkey").join(count(t.supplier, "s_nationkey", "suppliers"), "n_nationkey").select("n_name", "customers", "suppliers")


@query("WITH s AS (SELECT s_nationkey AS k, round(sum(s_acctbal), 2) AS supply FROM supplier GROUP BY 1), d AS (SELECT c_nationkey AS k, round(sum(c_acctbal), 2) AS demand FROM customer GROUP BY 1) SELECT d.k AS nationkey, demand, coalesce(supply, 0) AS supply, CASE WHEN supply IS NULL THEN 'none' WHEN supply > 0.1 * demand THEN 'over' ELSE 'under' END AS verdict FROM d LEFT JOIN s USING (k)")
def demand_supply(t):
    total = lambda df, k, v, name: df.groupBy(F.col(k).alias("nationkey")).agg(F.round(F.sum(v), 2).alias(name))
    j = total(t.customer, "c_nationkey", "c_acctbal", "demand").join(total(t.supplier, "s_nationkey", "s_acctbal", "supply"), "nationkey", "left")
    verdict = F.when(F.col("supply").isNull(), "none").when(F.col("supply") > 0.1 * F.col("demand"), "over").otherwise("under")
    return j.select("nationkey", "demand", F.coalesce("supply", F.lit(0.0)).alias("supply"), verdict.alias("verdict"))
