"""Views, filters, aggregations, shares and reports on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import checks
from ..plans import views
from ..functions import is_blank
from .registry import query

STATUS_EDGES = [(50_000, "small"), (150_000, "medium"), (300_000, "large"), (None, "huge")]


@query("""SELECT o_orderkey, c_name, n_name, l_partkey, l_suppkey, l_linenumber, l_extendedprice, 'CFG' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE l_quantity >= 49""")
def v_overview(t):
    n = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    return t.lineitem.filter("l_quantity >= 49").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", F.lit("CFG").alias("source"))


@query("""SELECT c_custkey, any_value(c_name) AS name, count(DISTINCT o_orderstatus) AS statuses, count(o_orderkey) AS orders, max(o_totalprice) AS most, min(o_totalprice) AS least,
coalesce(string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority), '') AS priorities
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def v_org_summary(t):
    o = t.orders.groupBy("o_custkey").agg(F.countDistinct("o_orderstatus").alias("statuses"), F.count("o_orderkey").alias("orders"), F.max("o_totalprice").alias("most"), F.min("o_totalprice").alias("least"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("c_name").alias("name"), zero("statuses"), zero("orders"), "most", "least", F.coalesce("priorities", F.lit("")).alias("priorities"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def v_amount_rank(t):
    return t.orders.filter("o_totalprice is not null").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""SELECT n_name, c_mktsegment, count(*) AS n, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS positive, round(sum(c_acctbal), 2) AS total, round(avg(c_acctbal), 4) AS mean, min(c_acctbal) AS least, max(c_acctbal) AS most
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment""")
def v_taxonomy(t):
    return t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("positive"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.round(F.avg("c_acctbal"), 4).alias("mean"), F.min("c_acctbal").alias("least"), F.max("c_acctbal").alias("most"))


@query("""WITH x AS (SELECT count(*) AS total, count(*) FILTER (c_acctbal > 0) AS a, count(*) FILTER (c_mktsegment IS NOT NULL AND c_mktsegment <> '') AS b, count(*) FILTER (c_acctbal >= 5000) AS c FROM customer)
SELECT item, filled, total, round(100.0::DOUBLE * filled / total, 2) AS percent, CASE WHEN round(100.0::DOUBLE * filled / total, 2) >= 90 THEN 'PASS' WHEN round(100.0::DOUBLE * filled / total, 2) >= 50 THEN 'WARN' ELSE 'FAIL' END AS status
FROM (SELECT 'positive' AS item, a AS filled, total FROM x UNION ALL SELECT 'segment', b, total FROM x UNION ALL SELECT 'rich', c, total FROM x)""")
def v_coverage(t):
    c = A.coverage(t.customer, {"positive": F.col("c_acctbal") > 0, "segment": ~is_blank(F.col("c_mktsegment")), "rich": F.col("c_acctbal") >= 5000})
    return c.withColumn("status", A.verdict(F.col("percent"), 90, 50))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY 1, 2")
def group_count(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("discount"))


@query("SELECT user_id, count(DISTINCT event_type) AS kinds, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS names FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1")
def multi_funder(t):
    return t.events.groupBy("user_id").agg(F.countDistinct("event_type").alias("kinds"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("names")).filter("kinds > 1")


@query("SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS statuses FROM orders GROUP BY o_custkey HAVING count(*) >= 2 AND count(DISTINCT o_orderstatus) >= 2")
def having_multi_award(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderstatus").alias("statuses")).filter("n >= 2 and statuses >= 2")


@query("""SELECT c_custkey, max_by(o_orderkey, (o_totalprice, -o_orderkey)) AS argmax_order, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def bare_column_argmax(t):
    return t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("argmax_order"), F.count(F.lit(1)).alias("n"))


@query("""SELECT n_name, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '2-HIGH') AS high, count(*) FILTER (o_orderpriority = '3-MEDIUM') AS medium, count(*) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def pivot_matrix(t):
    # counts per customer first: the join then carries one row per customer and priority
    o = t.orders.groupBy("o_custkey", "o_orderpriority").count()
    c = o.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    of = lambda p: F.coalesce(F.sum(F.when(F.col("o_orderpriority") == p, F.col("count"))), F.lit(0))
    return c.groupBy("n_name").agg(of("1-URGENT").alias("urgent"), of("2-HIGH").alias("high"), of("3-MEDIUM").alias("medium"), F.sum("count").alias("total"))


@query("WITH s AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT round(10000.0::DOUBLE * sum(n * n) / (sum(n) * sum(n)), 6) AS hhi, count(*) AS members, round(max(n)::DOUBLE / sum(n), 6) AS top_share FROM s")
def hhi(t):
    return A.hhi(t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")))


@query("""WITH s AS (SELECT p_brand, l_suppkey, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_brand, round(10000.0::DOUBLE * sum(n * n) / (sum(n) * sum(n)), 6) AS hhi, count(*) AS members, round(max(n)::DOUBLE / sum(n), 6) AS top_share FROM s GROUP BY p_brand""")
def hhi_group(t):
    s = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return A.hhi(s, by=["p_brand"])


@query("SELECT c_mktsegment, round(median(c_acctbal), 4) AS averaged, list_sort(list(c_acctbal))[CAST(count(*) // 2 + 1 AS BIGINT)] AS upper FROM customer GROUP BY c_mktsegment")
def medians(t):
    return t.customer.groupBy("c_mktsegment").agg(F.round(F.median("c_acctbal"), 4).alias("averaged"), A.upper_median("c_acctbal").alias("upper"))


@query("WITH s AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) SELECT c_mktsegment, n, round(n / sum(n) OVER (), 6) AS share, round(n::DOUBLE / max(n) OVER (), 6) AS of_most FROM s")
def share(t):
    s = A.with_share(t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "n")
    return s.withColumn("of_most", F.round(F.col("n") / F.max("n").over(A.every()), 6))


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1),
x AS (SELECT k, n, round(n / sum(n) OVER (), 6) AS share_a FROM a), y AS (SELECT k, round(n / sum(n) OVER (), 6) AS share_b FROM b)
SELECT x.k AS nationkey, share_a, share_b, round(share_a / share_b, 6) AS ratio, round(share_a - coalesce(share_b, 0), 6) AS gap FROM x LEFT JOIN y USING (k) WHERE n >= 8""")
def representation(t):
    a = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return A.representation(a, b, "nationkey", 8)


@query("""WITH b AS (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1), h AS (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem WHERE l_quantity >= 45 GROUP BY 1)
SELECT b.flag, b.n AS base, coalesce(h.n, 0) AS hits, round(1000.0::DOUBLE * coalesce(h.n, 0) / b.n, 6) AS per_base FROM b LEFT JOIN h USING (flag) WHERE b.n >= 500""")
def intensity(t):
    count = lambda df: df.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    return A.intensity(count(t.lineitem), count(t.lineitem.filter("l_quantity >= 45")), "flag", 500)


@query("""WITH b(place, bucket) AS (VALUES (0, 'small'), (1, 'medium'), (2, 'large'), (3, 'huge')),
o AS (SELECT CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 150000 THEN 'medium' WHEN o_totalprice < 300000 THEN 'large' WHEN o_totalprice IS NOT NULL THEN 'huge' END AS bucket, count(*) AS n, sum(o_totalprice) AS amount FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT b.place, b.bucket, coalesce(n, 0) AS n, round(coalesce(amount, 0), 2) AS amount FROM b LEFT JOIN o USING (bucket)""")
def histogram(t):
    o = t.orders.filter("o_orderpriority = '1-URGENT'")
    return A.histogram(o, F.col("o_totalprice"), STATUS_EDGES, F.col("o_totalprice")).withColumn("amount", F.round("amount", 2))


@query("""SELECT CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 150000 THEN 'medium' WHEN o_totalprice < 300000 THEN 'large' ELSE 'huge' END AS tier, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p, round(sum(o_totalprice), 2) AS weighted FROM orders GROUP BY 1""")
def tier_matrix(t):
    tier = A.bucket(F.col("o_totalprice"), STATUS_EDGES).alias("tier")
    of = lambda s: F.count_if(F.col("o_orderstatus") == s).alias(s.lower())
    return t.orders.groupBy(tier).agg(of("O"), of("F"), of("P"), F.round(F.sum("o_totalprice"), 2).alias("weighted"))


@query("""WITH c AS (SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT r_name, n_name, 2 AS depth, customers, round(balance, 2) AS balance FROM c UNION ALL SELECT r_name, NULL, 1, sum(customers)::BIGINT, round(sum(balance), 2) FROM c GROUP BY r_name""")
def rollup_hierarchy(t):
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    leaves = c.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    return A.rolled_up(leaves, ["r_name", "n_name"], ["customers", "balance"]).withColumn("balance", F.round("balance", 2))


@query("""WITH c AS (SELECT c_nationkey, count(DISTINCT c_mktsegment) AS segments, round(median(c_acctbal), 4) AS middle, round(avg(c_acctbal), 4) AS mean, round(100.0::DOUBLE * count(*) FILTER (c_acctbal < 0) / count(*), 4) AS negative FROM customer GROUP BY 1),
r AS (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer)
SELECT n_name, segments, middle, mean, negative, (SELECT string_agg(c_name, '|' ORDER BY k) FROM r WHERE r.c_nationkey = c.c_nationkey AND k <= 3) AS top3 FROM c JOIN nation ON c.c_nationkey = n_nationkey""")
def profile(t):
    one = t.customer.groupBy("c_nationkey").agg(F.countDistinct("c_mktsegment").alias("segments"), F.round(F.median("c_acctbal"), 4).alias("middle"), F.round(F.avg("c_acctbal"), 4).alias("mean"), F.round(100.0 * F.count_if(F.col("c_acctbal") < 0) / F.count(F.lit(1)), 4).alias("negative"))
    top = A.top_k(t.customer, ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "c_name"))), lambda x: x["c_name"]), "|").alias("top3"))
    return one.join(top, "c_nationkey").join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "segments", "middle", "mean", "negative", "top3")


@query("""WITH s AS (SELECT l_suppkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT))::BIGINT AS n FROM lineitem GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n DESC, l_suppkey) AS k FROM s)
SELECT count(*) AS members, sum(n)::BIGINT AS total, round((sum(n) FILTER (k <= 15))::DOUBLE / sum(n)::DOUBLE, 6) AS share FROM r""")
def topk_share(t):
    s = t.lineitem.groupBy("l_suppkey").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("n"))
    return A.top_share(s, "n", [F.desc("n"), F.col("l_suppkey")], 15)


@query("""SELECT c_mktsegment, count(*) AS n, round(avg(CASE WHEN c_name LIKE '%1%' THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS with_term, round(count(*) FILTER (c_nationkey = 1)::DOUBLE / count(*), 6) AS of_value, count(c_acctbal) AS amounts, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1""")
def dominance(t):
    return t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.contains("c_name", F.lit("1")).cast("double")), 6).alias("with_term"), F.round(F.count_if(F.col("c_nationkey") == 1) / F.count(F.lit(1)), 6).alias("of_value"), F.count("c_acctbal").alias("amounts"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("""WITH s AS (SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM events), 2) AS share FROM events GROUP BY 1),
m AS (SELECT *, 100 * ln(1 + share) / max(ln(1 + share)) OVER () AS norm FROM s)
SELECT event_type, n, share, round(norm, 4) AS norm, round((100 - norm) * share, 4) AS opportunity, row_number() OVER (ORDER BY share DESC, event_type) AS rank FROM m""")
def score_log(t):
    from pyspark.sql import Window

    s = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(A.every()), 2))
    m = A.log_score(s, "share")
    return m.select("event_type", "n", "share", F.round("norm", 4).alias("norm"), F.round((100 - F.col("norm")) * F.col("share"), 4).alias("opportunity"), F.row_number().over(Window.orderBy(F.desc("share"), "event_type")).alias("rank"))


@query("""WITH k AS (SELECT n_nationkey AS k FROM nation), a AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1), b AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
c AS (SELECT c_nationkey AS k, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000 GROUP BY 1)
SELECT coalesce(a.k, b.k, c.k) AS nationkey, coalesce(a.n, 0) AS suppliers, coalesce(b.n, 0) AS customers, coalesce(c.n, 0) AS large_orders FROM a FULL JOIN b ON a.k = b.k FULL JOIN c ON coalesce(a.k, b.k) = c.k""")
def full_combo(t):
    count = lambda df, k: df.groupBy(F.col(k).alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    o = t.orders.filter("o_totalprice > 300000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return A.zero_filled_union({"suppliers": count(t.supplier, "s_nationkey"), "customers": count(t.customer, "c_nationkey"), "large_orders": count(o, "c_nationkey")}, "nationkey")


@query("""WITH d AS (SELECT c_nationkey AS k, count(*) AS demand FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS supply FROM supplier GROUP BY 1),
t AS (SELECT d.k, demand, supply FROM d LEFT JOIN s USING (k) ORDER BY demand DESC, d.k LIMIT 22)
SELECT k AS nationkey, demand, supply FROM t WHERE supply IS NULL OR supply::DOUBLE / demand < 0.006""")
def topk_then_filter(t):
    o = t.orders.groupBy("o_custkey").count().join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    d = o.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.sum("count").alias("demand"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("supply"))
    return d.join(s, "nationkey", "left").orderBy(F.desc("demand"), "nationkey").limit(22).filter(F.col("supply").isNull() | (F.col("supply") / F.col("demand") < 0.006))


@query("""SELECT count(*) AS n, count(DISTINCT p_brand) AS brands FROM part WHERE p_type ILIKE '%Econ%' AND p_name ILIKE '%R%g%' AND p_name NOT ILIKE '%gear%'""")
def like_multi(t):
    c = F.col
    return t.part.filter(c("p_type").ilike("%Econ%") & c("p_name").ilike("%R%g%") & ~c("p_name").ilike("%gear%")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_brand").alias("brands"))


@query("SELECT p_partkey, p_size FROM part WHERE coalesce(nullif(p_size, 1), 9999) > 45")
def sentinel(t):
    return t.part.filter(F.coalesce(F.nullif("p_size", F.lit(1)), F.lit(9999)) > 45).select("p_partkey", "p_size")


@query("SELECT doc_id, lang FROM documents WHERE length(text) > 50 AND length(text) BETWEEN 100 AND 400 AND lang IN ('en', 'de') AND source <> ''")
def between_len(t):
    n = F.char_length("text")
    return t.documents.filter((n > 50) & n.between(100, 400) & F.col("lang").isin("en", "de") & (F.col("source") != "")).select("doc_id", "lang")


@query("""SELECT event_type, round(sum(value), 2) AS total, count(*) AS n, count(CASE WHEN value > 50 THEN 1 END) AS above, round(avg(value), 6) AS mean, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS users FROM events GROUP BY event_type""")
def conditional_agg(t):
    big = F.col("value") > 50
    return t.events.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"), F.count_if(big).alias("above"), F.round(F.avg("value"), 6).alias("mean"), F.countDistinct(F.when(big, F.col("user_id"))).alias("users"))


@query("SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM supplier) AS suppliers, (SELECT count(*) FROM part) AS parts")
def scalar_stats(t):
    return views.scalars(customers=t.customer, orders=t.orders, suppliers=t.supplier, parts=t.part)


@query("""(SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name AS label FROM customer WHERE c_name ILIKE '%00001%' ORDER BY c_custkey LIMIT 20)
UNION ALL (SELECT 'part', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_name ILIKE '%00001%' OR p_brand ILIKE '%00001%' ORDER BY p_partkey LIMIT 20)
UNION ALL (SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier WHERE s_name ILIKE '%00001%' ORDER BY s_suppkey LIMIT 20)""")
def unified_search(t):
    return views.search({"customer": (t.customer, "c_custkey", ["c_name"], "c_name"), "part": (t.part, "p_partkey", ["p_name", "p_brand"], "p_name"), "supplier": (t.supplier, "s_suppkey", ["s_name"], "s_name")}, "00001", 20)


@query("""WITH o AS (SELECT o_orderkey AS id, 'order ' || o_orderkey AS title, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deadline, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS status FROM orders),
a AS (SELECT 'CFG' AS source, * FROM o WHERE id % 2 = 0 AND (deadline >= '1998-01-01' OR status = 'open') ORDER BY coalesce(deadline, '9999-12-31'), id LIMIT 40),
b AS (SELECT 'GDB' AS source, * FROM o WHERE id % 2 = 1 AND (deadline >= '1998-01-01' OR status = 'open') ORDER BY coalesce(deadline, '9999-12-31'), id LIMIT 40)
SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) ORDER BY coalesce(deadline, '9999-12-31'), source, id LIMIT 40""")
def upcoming_calls(t):
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"), F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("deadline"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("status"))
    return views.upcoming(o.filter("id % 2 = 0"), o.filter("id % 2 = 1"), "1998-01-01", 40)


@query("""SELECT 'orders' AS section, k AS "check", CASE WHEN n < 1 THEN 'PASS' WHEN n >= f THEN 'FAIL' ELSE 'WARN' END AS status, n || '/' || total AS detail FROM (
SELECT 'negative price' AS k, count(*) FILTER (o_totalprice < 0) AS n, 1 AS f, count(*) AS total FROM orders UNION ALL
SELECT 'no status', count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus = ''), 1, count(*) FROM orders UNION ALL
SELECT 'cheap', count(*) FILTER (o_totalprice < 10000), 1000000, count(*) FROM orders)
UNION ALL SELECT 'orders', 'customer exists', CASE WHEN count(*) < 1 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS VARCHAR) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'orders', 'status known', CASE WHEN count(*) < 1 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')""")
def verification(t):
    o = t.orders
    tests = {"negative price": (F.col("o_totalprice") < 0, 1, 1), "no status": (is_blank(F.col("o_orderstatus")), 1, 1), "cheap": (F.col("o_totalprice") < 10000, 1, 1_000_000)}
    return checks.report(checks.rows("orders", o, tests), checks.orphans("orders", "customer exists", o, t.customer, "o_custkey", "c_custkey"), checks.allowed("orders", "status known", o, "o_orderstatus", ["O", "F"]))


@query("""SELECT 'documents' AS section, k AS "check", CASE WHEN rate <= 0.2 THEN 'PASS' WHEN rate <= 0.5 THEN 'WARN' ELSE 'FAIL' END AS status, CAST(round(rate, 6) AS VARCHAR) AS detail FROM (
SELECT 'lang' AS k, avg(CASE WHEN lang IS NULL OR lang = '' THEN 1.0::DOUBLE ELSE 0 END) AS rate FROM documents UNION ALL
SELECT 'source', avg(CASE WHEN nullif(source, 'src0') IS NULL THEN 1.0::DOUBLE ELSE 0 END) FROM documents)""")
def null_rates(t):
    d = t.documents.select("lang", F.nullif("source", F.lit("src0")).alias("source"))
    return checks.null_rates("documents", d, ["lang", "source"])


@query("SELECT lower(trim(text)) AS key, count(*) AS n, min(doc_id) AS first FROM documents WHERE text <> '' GROUP BY 1 HAVING count(*) > 1")
def dup_groups(t):
    return checks.duplicates(t.documents, F.lower(F.trim("text")), "doc_id")


@query("SELECT lower(substring(p_name, 1, 6)) AS key, count(DISTINCT substring(p_name, 1, 8)) AS n, list_aggregate(list_sort(list(DISTINCT substring(p_name, 1, 8))), 'string_agg', '|') AS spellings FROM part GROUP BY 1 HAVING count(DISTINCT substring(p_name, 1, 8)) > 1")
def variants(t):
    v = checks.variants(t.part, F.lower(F.substring("p_name", 1, 6)), F.substring("p_name", 1, 8))
    return v.withColumn("spellings", F.array_join("spellings", "|"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 300000)
SELECT (SELECT count(*) FROM a) AS "left", (SELECT count(*) FROM b) AS "right", (SELECT count(*) FROM a WHERE k IN (SELECT k FROM b)) AS both, round((SELECT count(*) FROM a WHERE k IN (SELECT k FROM b)) / nullif((SELECT count(*) FROM a), 0)::DOUBLE, 6) AS rate""")
def set_overlap(t):
    o = t.orders.withColumnRenamed("o_custkey", "k")
    return checks.overlap(o.filter("o_orderstatus = 'P'"), o.filter("o_totalprice > 300000"), "k")


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersection(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))


@query("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_difference(t):
    return t.nation.select(F.col("n_nationkey").alias("k")).subtract(t.supplier.filter("s_acctbal > 5000").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0 UNION SELECT s_nationkey FROM supplier")
def set_union(t):
    return t.customer.filter("c_acctbal < 0").select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("SELECT DISTINCT p_brand, p_size FROM part WHERE p_size < 10")
def distinct_rows(t):
    return t.part.filter("p_size < 10").select("p_brand", "p_size").distinct()


@query()
def sample_rows(t):
    """A seeded sample of 100 documents."""
    return t.documents.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(100).select("doc_id")
