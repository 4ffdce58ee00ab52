"""Merging, gating and selection on the test tables: customers split into current and incoming rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merging as U
from ..sources import readers
from .registry import query

_CUR = "(SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment, c_acctbal AS amount, c_nationkey AS nation FROM customer WHERE c_custkey % 3 <> 0)"
_NEW = "(SELECT c_custkey AS id, upper(c_name) AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_acctbal + 1 AS amount, c_nationkey AS nation FROM customer WHERE c_custkey % 2 = 0)"


def _current(t):
    c = F.col
    return t.customer.filter("c_custkey % 3 <> 0").select(c("c_custkey").alias("id"), c("c_name").alias("name"), F.when(c("c_custkey") % 4 == 0, "").otherwise(c("c_mktsegment")).alias("segment"), c("c_acctbal").alias("amount"), c("c_nationkey").alias("nation"))


def _incoming(t):
    c = F.col
    return t.customer.filter("c_custkey % 2 = 0").select(c("c_custkey").alias("id"), F.upper("c_name").alias("name"), F.when(c("c_custkey") % 5 != 0, c("c_mktsegment")).alias("segment"), (c("c_acctbal") + 1).alias("amount"), c("c_nationkey").alias("nation"))


@query(f"SELECT coalesce(n.id, o.id) AS id, coalesce(n.name, o.name) AS name, coalesce(n.segment, o.segment) AS segment, round(coalesce(n.amount, o.amount), 2) AS amount FROM {_CUR} o FULL JOIN {_NEW} n ON o.id = n.id")
def merge_upsert(t):
    return U.upsert(_current(t), _incoming(t), ["id"], ["name", "segment", "amount"])[0].withColumn("amount", F.round("amount", 2))


@query(f"SELECT count(*) FILTER (n.id IS NOT NULL AND o.id IS NULL) AS inserted, count(*) FILTER (n.id IS NOT NULL AND o.id IS NOT NULL) AS updated, count(*) FILTER (n.id IS NULL) AS kept FROM {_CUR} o FULL JOIN {_NEW} n ON o.id = n.id")
def merge_plan(t):
    return U.upsert(_current(t), _incoming(t), ["id"], ["name"])[1]


@query(f"SELECT o.id, o.name, coalesce(nullif(o.segment, ''), n.segment) AS segment, o.amount FROM {_CUR} o LEFT JOIN {_NEW} n ON o.id = n.id")
def merge_fill(t):
    return U.fill_blanks(_current(t), _incoming(t), "id", ["segment"]).select("id", "name", "segment", "amount")


@query(f"SELECT id, name FROM {_CUR} UNION ALL SELECT id, name FROM {_NEW} WHERE id NOT IN (SELECT id FROM {_CUR})")
def insert_or_ignore(t):
    return U.insert_or_ignore(_current(t), _incoming(t), ["id"]).select("id", "name")


@query(f"SELECT id, name FROM {_CUR} WHERE nation NOT IN (SELECT nation FROM {_NEW} WHERE nation < 5) UNION ALL SELECT id, name FROM {_NEW} WHERE nation < 5")
def replace_part(t):
    return U.replace_slices(_current(t), _incoming(t).filter("nation < 5"), ["nation"]).select("id", "name")


@query("""WITH r AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM supplier)
SELECT (SELECT p.s_suppkey FROM r p WHERE p.s_nationkey = r.s_nationkey AND p.k = 1) AS id, arg_min(name, k) FILTER (name IS NOT NULL) AS name, count(*) - 1 AS absorbed FROM r GROUP BY s_nationkey""")
def dedup_merge(t):
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("name"), "s_nationkey", "s_acctbal")
    primaries, gone = U.absorb_duplicates(s, F.col("s_nationkey"), [F.desc("s_acctbal"), F.col("id")], "id", ["name"])
    n = gone.groupBy(F.col("new_id").alias("id")).agg(F.count(F.lit(1)).alias("absorbed"))
    return primaries.select("id", "name").join(n, "id", "left").withColumn("absorbed", F.coalesce("absorbed", F.lit(0)))


@query("""WITH m AS (SELECT s_suppkey AS old_id, first_value(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS new_id FROM supplier)
SELECT new_id AS l_suppkey, count(*) AS n FROM lineitem JOIN m ON l_suppkey = old_id GROUP BY 1""")
def repoint_children(t):
    _, gone = U.absorb_duplicates(t.supplier, F.col("s_nationkey"), [F.desc("s_acctbal"), F.col("s_suppkey")], "s_suppkey", [])
    return U.repoint(t.lineitem, gone, "l_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, CASE WHEN f <> doc_id THEN f END AS duplicate_of FROM (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text ORDER BY doc_id) AS f FROM documents)""")
def soft_dedup(t):
    return U.soft_duplicates(t.documents, F.col("text"), [F.col("doc_id")], "doc_id").select("doc_id", "duplicate_of")


@query("""SELECT s_suppkey, CASE WHEN k = 1 AND s_nationkey <> 3 THEN s_name END AS s_name FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM supplier)""")
def resolve_collisions(t):
    return U.resolve_collisions(t.supplier, "s_name", F.col("s_nationkey"), [F.desc("s_acctbal"), F.col("s_suppkey")], F.col("s_nationkey") == 3).select("s_suppkey", "s_name")


@query(f"SELECT o.id, o.name AS old, n.name AS new FROM {_CUR} o JOIN {_NEW} n ON o.id = n.id AND o.name <> n.name")
def supersede_log(t):
    return U.supersede(_current(t), _incoming(t), "id", "name")[1]


@query(f"SELECT id, name FROM {_CUR} UNION ALL SELECT id, name FROM {_NEW} WHERE segment IS NOT NULL AND id NOT IN (SELECT id FROM {_CUR})")
def append_missing(t):
    return U.append_missing(_current(t), _incoming(t), "id", [F.col("segment").isNull(), F.col("name")], F.col("segment").isNotNull()).select("id", "name")


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 7 AND c_custkey % 2 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, CASE WHEN c_nationkey = 7 AND c_custkey % 2 = 0 THEN 'c_nationkey|7|wrong source' END AS audit FROM customer""")
def null_out_corrections(t):
    bad = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", F.lit(7).alias("bad"), F.lit("wrong source").alias("reason"))
    return U.correct(t.customer, bad, "c_custkey", "c_nationkey").select("c_custkey", "c_nationkey", "audit")


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE -1 END, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey)) AS awards FROM customer""")
def fill_from_children(t):
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 2 != 0, F.lit(-1).cast("long")).alias("awards"))
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return U.fill_from_children(c, o, "c_custkey", "awards", F.count(F.lit(1))).withColumn("awards", F.coalesce("awards", F.lit(0)))


@query("""WITH w AS (SELECT o_orderkey AS id, 'status' AS type, o_orderstatus AS value FROM orders UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders)
SELECT id, type, value FROM w WHERE NOT (type = 'status' AND id % 100 = 0) UNION ALL SELECT o_orderkey, 'status', 'X' FROM orders WHERE o_orderkey % 100 = 0""")
def insert_missing_types(t):
    orders = t.orders
    o = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    have = o.filter("id % 100 = 0").select("id", F.lit("status").alias("type"), F.lit("X").alias("value"))
    return U.insert_missing_types(have, o, "id", ["status", "priority"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def purge(t):
    parents = t.customer.filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return U.purge_orphans(t.orders, parents, "o_custkey").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def attempt_ledger(t):
    tried = t.orders.filter("o_orderstatus = 'P'").select(F.nullif("o_custkey", F.lit(-1)).alias("c_custkey"))
    return U.without_attempted(t.customer, tried, "c_custkey").select("c_custkey")


@query("SELECT 'seg_' || substring(sha256(trim(c_mktsegment)), 1, 12) AS id, count(*) AS n FROM customer WHERE trim(c_mktsegment) <> '' GROUP BY 1")
def derive_dimension(t):
    dim, facts = U.derive_dimension(t.customer, "c_mktsegment", "seg_")
    return facts.join(dim, facts["c_mktsegment_id"] == dim["id"]).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN l_quantity < 5 THEN 'few' WHEN l_discount >= 0.09 THEN 'discount' WHEN NOT l_extendedprice BETWEEN 2000 AND 90000 THEN 'range' END AS reason FROM lineitem) GROUP BY reason""")
def reject_reason(t):
    c = F.col
    g = U.gate(t.lineitem, [("few", c("l_quantity") < 5), ("discount", c("l_discount") >= 0.09), ("range", ~c("l_extendedprice").between(2000, 90000))])
    return g.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey FROM (SELECT * FROM customer WHERE c_acctbal < 0 ORDER BY c_nationkey, c_acctbal, c_custkey LIMIT 50) WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 350000)""")
def work_queue(t):
    staged = t.orders.filter("o_totalprice > 350000").select(F.col("o_custkey").alias("c_custkey"))
    return readers.work_queue(t.customer, staged, "c_custkey", F.col("c_acctbal") < 0, [F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_custkey")], 50).select("c_custkey")


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 2 THEN NULL ELSE c_acctbal END AS amount FROM customer WHERE NOT (c_nationkey = 2 AND c_custkey % 2 = 0)""")
def reviewed_guard(t):
    """Fields nulled in a review aren't taken in again: an anti-join on (id, field) of the review log."""
    c = t.customer.select("c_custkey", F.lit("amount").alias("field"), F.when(F.col("c_nationkey") != 2, F.col("c_acctbal")).alias("amount"))
    log = t.customer.filter("c_nationkey = 2 and c_custkey % 2 = 0").select("c_custkey", F.explode(F.array(F.lit("amount"), F.lit("year"))).alias("field"))
    return c.join(log, ["c_custkey", "field"], "left_anti").select("c_custkey", "amount")
