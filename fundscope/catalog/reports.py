"""The composed reports on the test tables: suppliers stand for organisations, parts for programmes, orders for calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import reports
from .registry import query

_STAR = """WITH o AS (SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_nationkey % 4 <> 3 THEN 'type' || (s_nationkey % 4) END AS subtype, 'nation' || s_nationkey AS place, CASE WHEN s_acctbal > 0 THEN CAST(floor(s_acctbal) AS BIGINT) * 1000000 END AS amount FROM supplier),
p AS (SELECT p_partkey AS id, p_partkey % 97 + 1 AS organization_id, p_type AS subcategories FROM part),
f AS (SELECT id AS organization_id, 'f' || (id % 5) AS category_id FROM o WHERE id % 3 <> 0),
c(id, level, name) AS (VALUES ('f0', 1, 'field 0'), ('f1', 1, 'field 1'), ('f2', 1, 'field 2'), ('f3', 1, 'field 3'), ('f4', 1, 'field 4'), ('f9', 1, 'field 9'), ('BRASS', 2, 'brass'), ('STEEL', 2, 'steel'), ('PROMO', 2, 'promo')),
t AS (SELECT id, CASE WHEN amount < 50000000 THEN 'T1' WHEN amount < 100000000 THEN 'T2' WHEN amount < 500000000 THEN 'T3' WHEN amount < 1000000000 THEN 'T4' WHEN amount < 5000000000 THEN 'T5' WHEN amount IS NOT NULL THEN 'T6' END AS tier FROM o),
x AS (SELECT organization_id, name AS field FROM f JOIN c ON category_id = c.id AND level = 1) """


def _star(t):
    c = F.col
    o = t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"), F.when(c("s_nationkey") % 4 != 3, F.concat(F.lit("type"), (c("s_nationkey") % 4).cast("string"))).alias("subtype"), F.concat(F.lit("nation"), c("s_nationkey").cast("string")).alias("place"), F.when(c("s_acctbal") > 0, F.floor("s_acctbal").cast("long") * 1_000_000).alias("amount"))
    p = t.part.select(c("p_partkey").alias("id"), (c("p_partkey") % 97 + 1).alias("organization_id"), c("p_type").alias("subcategories"))
    f = o.filter("id % 3 <> 0").select(c("id").alias("organization_id"), F.concat(F.lit("f"), (c("id") % 5).cast("string")).alias("category_id"))
    names = [(f"f{k}", 1, f"field {k}") for k in (0, 1, 2, 3, 4, 9)] + [(x, 2, x.lower()) for x in ("BRASS", "STEEL", "PROMO")]
    return o, p, f, t.spark.createDataFrame(names, "id string, level int, name string")


@query(_STAR + """SELECT 'subtype_field' AS section, subtype AS label, field AS other, count(DISTINCT p.id) AS n, count(DISTINCT o.id)::DOUBLE AS amount FROM p JOIN o ON p.organization_id = o.id LEFT JOIN x ON x.organization_id = o.id GROUP BY subtype, field
UNION ALL SELECT 'field_tier', field, tier, count(*), sum(amount)::DOUBLE FROM x JOIN o ON x.organization_id = o.id JOIN t ON t.id = o.id WHERE amount IS NOT NULL GROUP BY field, tier
UNION ALL SELECT 'subcategory', c.name, NULL, count(DISTINCT p.id), count(DISTINCT p.organization_id)::DOUBLE FROM p JOIN c ON level = 2 AND contains(subcategories, c.id) GROUP BY c.name
UNION ALL SELECT 'field_coverage', c.name, NULL, count(DISTINCT x.organization_id), NULL FROM c LEFT JOIN x ON x.field = c.name WHERE level = 1 GROUP BY c.name
UNION ALL SELECT 'amounts', NULL, NULL, count(amount), sum(amount)::DOUBLE FROM o""")
def job_structural_report(t):
    return reports.structural(*_star(t))


@query(_STAR + """SELECT 'subtype' AS section, coalesce(subtype, 'unset') AS label, NULL AS other, count(*) AS n, NULL::DOUBLE AS amount FROM o GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'place', place, NULL, count(*) AS n, NULL FROM o GROUP BY place ORDER BY n DESC, place LIMIT 15)
UNION ALL SELECT 'tier', tier, NULL, count(*), NULL FROM t WHERE tier IS NOT NULL GROUP BY tier
UNION ALL SELECT * FROM (SELECT 'largest', name, NULL, 1, amount::DOUBLE FROM o WHERE amount IS NOT NULL ORDER BY amount DESC, id LIMIT 30)
UNION ALL SELECT 'rows', 'organizations', NULL, count(*), NULL FROM o UNION ALL SELECT 'rows', 'programs', NULL, count(*), NULL FROM p UNION ALL SELECT 'rows', 'calls', NULL, count(*), NULL FROM orders""")
def job_dashboard(t):
    o, p, _, _ = _star(t)
    return reports.dashboard(o, p, t.orders, {"subtype": None, "place": 15})


#: Predicates that Spark and DuckDB read alike: (section, check, table, bad rows, warn from, fail from).
TESTS = [
    ("gaps", "supplier name", "supplier", "s_name IS NULL OR s_name = ''", 1, 10),
    ("gaps", "supplier nation", "supplier", "s_nationkey IS NULL", 1, 1),
    ("gaps", "customer segment", "customer", "c_mktsegment IS NULL OR c_mktsegment = ''", 1, 100),
    ("gaps", "part brand", "part", "p_brand IS NULL OR p_brand = ''", 1, 100),
    ("gaps", "part type", "part", "p_type IS NULL OR p_type = ''", 1, None),
    ("gaps", "order status", "orders", "o_orderstatus IS NULL OR o_orderstatus = ''", 1, 1),
    ("gaps", "page address", "pages", "url IS NULL OR url = ''", 1, None),
    ("ranges", "order price", "orders", "o_totalprice < 0", 1, 1),
    ("ranges", "cheap order", "orders", "o_totalprice < 10000", 1, 1_000_000),
    ("ranges", "quantity", "lineitem", "l_quantity <= 0 OR l_quantity > 50", 1, 1),
    ("ranges", "discount", "lineitem", "l_discount < 0 OR l_discount > 0.08", 1, 100_000_000),
    ("ranges", "tax", "lineitem", "l_tax < 0 OR l_tax > 1", 1, 1),
    ("ranges", "retail price", "part", "p_retailprice < 0", 1, 1),
    ("ranges", "debt", "customer", "c_acctbal < 0", 1, None),
    ("values", "order status", "orders", "o_orderstatus NOT IN ('O', 'F')", 1, 1),
    ("values", "return flag", "lineitem", "l_returnflag NOT IN ('A', 'N', 'R')", 1, 1),
    ("values", "event type", "events", "event_type NOT IN ('click', 'view', 'purchase')", 1, 1_000_000_000),
    ("freshness", "order before 1993", "orders", "o_orderdate < DATE '1993-01-01'", 1, None),
    ("freshness", "order after 2000", "orders", "o_orderdate > DATE '2000-01-01'", 1, 1),
]
REFERENCES = [
    ("integrity", "order's customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("integrity", "line's order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("integrity", "line's part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("integrity", "line's supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("integrity", "customer's nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("integrity", "supplier's nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("integrity", "nation's region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("integrity", "label's document", "labels", "doc_id", "documents", "doc_id"),
]
UNIQUE = [
    ("duplicates", "supplier name", "supplier", "s_name"),
    ("duplicates", "customer name", "customer", "c_name"),
    ("duplicates", "part name", "part", "p_name"),
    ("duplicates", "page address", "pages", "url"),
    ("duplicates", "document", "documents", "doc_id"),
    ("duplicates", "event", "events", "event_id"),
    ("duplicates", "item text", "benchmark", "text"),
]


def _suite_sql() -> str:
    state = lambda warn, fail: f"CASE WHEN n < {warn} THEN 'PASS' " + (f"WHEN n >= {fail} THEN 'FAIL' " if fail is not None else "") + "ELSE 'WARN' END"
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = [f"SELECT {quoted(s)} AS section, {quoted(c)} AS \"check\", {state(warn, fail)} AS status, n || '/' || total AS detail FROM (SELECT count(*) FILTER ({bad}) AS n, count(*) AS total FROM {table})" for s, c, table, bad, warn, fail in TESTS]
    parts += [f"SELECT {quoted(s)}, {quoted(c)}, {state(1, 1)}, CAST(n AS VARCHAR) FROM (SELECT count(*) AS n FROM {a} WHERE {ka} IS NOT NULL AND {ka} NOT IN (SELECT {kb} FROM {b}))" for s, c, a, ka, b, kb in REFERENCES]
    parts += [f"SELECT {quoted(s)}, {quoted(c)}, {state(1, None)}, CAST(n AS VARCHAR) FROM (SELECT count(*) AS n FROM (SELECT {k} FROM {table} WHERE {k} IS NOT NULL AND trim(CAST({k} AS VARCHAR)) <> '' GROUP BY {k} HAVING count(*) > 1))" for s, c, table, k in UNIQUE]
    return " UNION ALL ".join(parts)


def _suite(t):
    names = {x for row in TESTS for x in (row[2],)} | {x for row in REFERENCES for x in (row[2], row[4])} | {row[2] for row in UNIQUE}
    return reports.suite({n: getattr(t, n) for n in names}, TESTS, REFERENCES, UNIQUE)


@query(_suite_sql())
def verification_suite(t):
    return _suite(t)


@query(f"SELECT section, status, count(*) AS n FROM ({_suite_sql()}) GROUP BY section, status")
def job_audit(t):
    return reports.audit(_suite(t))
