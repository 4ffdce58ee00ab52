"""Queries of the iterative operators: many patterns, one-to-one assignment, merged ids, order statistics, the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import matching as M
from ..operators import merging as U
from ..operators import patterns as P
from ..operators.gram_index import GramIndex, search_all
from ..store import shared_dir
from .registry import query


@query("""WITH p AS (SELECT item_id AS pid, array_to_string(string_split(text, ' ')[1:3], ' ') AS pattern FROM benchmark)
SELECT pid, doc_id AS tid, CAST(len(string_split(text, pattern)) - 1 AS BIGINT) AS times, CAST(strpos(text, pattern) AS INTEGER) AS first FROM p JOIN documents ON contains(text, pattern)""")
def pattern_hits_documents(t):
    """The three first words of every benchmark item in the whole documents."""
    p = t.benchmark.select(F.col("item_id").alias("pid"), F.substring_index("text", " ", 3).alias("pattern"))
    return P.held(p, t.documents.select(F.col("doc_id").alias("tid"), "text"))


@query("""WITH p AS (SELECT DISTINCT regexp_extract(url, '//([^/?#]+)', 1) AS pattern FROM pages WHERE regexp_extract(url, '//([^/?#]+)', 1) <> '')
SELECT pattern AS pid, page_id AS tid, CAST(strpos(html, pattern) AS INTEGER) AS first FROM p JOIN pages ON contains(html, pattern)
UNION ALL SELECT n_name, page_id, CAST(strpos(upper(html), n_name) AS INTEGER) FROM nation JOIN pages ON contains(upper(html), n_name)""")
def pattern_hits_pages(t):
    """Hosts of the pages, and names of nations whatever their case, in the pages' source."""
    host = F.regexp_extract("url", "//([^/?#]+)", 1)
    hosts = t.pages.select(host.alias("pid"), host.alias("pattern")).distinct()
    names = t.nation.select(F.col("n_name").alias("pid"), F.col("n_name").alias("pattern"))
    one = P.held(hosts, t.pages.select(F.col("page_id").alias("tid"), F.col("html").alias("text")))
    two = P.held(names, t.pages.select(F.col("page_id").alias("tid"), F.upper("html").alias("text")))
    return one.unionByName(two).select("pid", "tid", "first")


@query("""WITH n AS (SELECT s_suppkey AS nid, 'unit ' || s_suppkey AS name FROM supplier),
k AS (SELECT 'unit ' || (3 * o_custkey) AS key, min(CASE WHEN regexp_matches(o_orderpriority, '^[1-3]-') THEN substr(o_orderpriority, 1, 1) END) AS value FROM orders GROUP BY 1),
m AS (SELECT nid, key, value, CASE WHEN name = key THEN 'equal' ELSE 'contains' END AS how,
      row_number() OVER (PARTITION BY nid ORDER BY name <> key, key) AS r FROM n JOIN k ON value IS NOT NULL AND (contains(key, name) OR contains(name, key)))
SELECT nid, m.key, value, how FROM n LEFT JOIN (SELECT * FROM m WHERE r = 1) m USING (nid)""")
def lookup_chained(t):
    """A name's own cached text, else the first of a name that contains it or lies in it, as far as something is drawn."""
    names = t.supplier.select(F.col("s_suppkey").alias("nid"), F.concat(F.lit("unit "), F.col("s_suppkey").cast("string")).alias("name"))
    cache = t.orders.select(F.concat(F.lit("unit "), (3 * F.col("o_custkey")).cast("string")).alias("key"), F.col("o_orderpriority").alias("text"))
    return P.chained_lookup(names, cache, F.when(F.col("text").rlike("^[1-3]-"), F.substring("text", 1, 1)))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS lid, l_partkey AS rid FROM lineitem),
l AS (SELECT lid, list_sort(list(rid)) AS rids, row_number() OVER (ORDER BY lid) AS k FROM e GROUP BY lid),
s AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS lid, CAST(NULL AS BIGINT) AS rid
  UNION ALL SELECT k, CASE WHEN free IS NULL THEN used ELSE list_append(used, free) END, lid, free
  FROM (SELECT l.k, s.used, l.lid, list_filter(l.rids, lambda x: NOT list_contains(s.used, x))[1] AS free FROM s JOIN l ON l.k = s.k + 1))
SELECT lid, rid FROM s WHERE rid IS NOT NULL""")
def greedy_assignment(t):
    """Suppliers in order, each with its first part that no earlier one took."""
    return M.greedy(t.lineitem.select(F.col("l_suppkey").alias("lid"), F.col("l_partkey").alias("rid")), "lid", "rid")[0]


@query("""WITH RECURSIVE m AS (SELECT c_custkey AS a, c_custkey - 1 AS b FROM customer WHERE c_custkey % 16 <> 0),
r AS (SELECT a, b, 1 AS steps FROM m UNION ALL SELECT r.a, m.b, steps + 1 FROM r JOIN m ON m.a = r.b),
e AS (SELECT a, arg_max(b, steps) AS b FROM r GROUP BY a)
SELECT coalesce(b, o_custkey) AS o_custkey, count(*) AS n FROM orders LEFT JOIN e ON a = o_custkey GROUP BY 1""")
def merged_chains(t):
    """Customers merged one into the next, in chains of 15; orders follow to the last one."""
    gone = t.customer.filter("c_custkey % 16 <> 0").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") - 1).alias("new_id"))
    return U.repoint(t.orders.select("o_custkey"), gone, "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT l_returnflag, list_sort(list(l_extendedprice)) AS v FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT l_returnflag, CAST(len(v) AS BIGINT) AS n, v[CAST(floor(0.5 * (len(v) - 1)) AS BIGINT) + 1] AS lower, v[CAST(ceil(0.5 * (len(v) - 1)) AS BIGINT) + 1] AS upper FROM s""")
def medians_of_large_groups(t):
    """Exact medians by selection in passes; three groups hold all rows of the largest table."""
    return A.order_statistics(t.lineitem, "l_returnflag", "l_extendedprice", few=2_000)


TERMS = ["", "7", "00", "0001", "OLD W", "brand#1", "mer#000000", "gone", "%", "Ürn"]


@query("WITH " + """c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'Ürne gone ' || c_custkey ELSE c_name END AS name FROM customer),
q AS (SELECT unnest([""" + ", ".join(f"'{x}'" for x in TERMS) + """]) AS term),
r AS (SELECT term, 'customer' AS kind, id, name AS label, row_number() OVER (PARTITION BY term ORDER BY id) AS n FROM q JOIN c ON contains(lower(name), lower(term))
UNION ALL SELECT term, 'part', p_partkey, p_name, row_number() OVER (PARTITION BY term ORDER BY p_partkey) FROM q JOIN part ON contains(lower(p_name), lower(term)) OR contains(lower(p_brand), lower(term)))
SELECT term, kind, CAST(id AS VARCHAR) AS id, label FROM r WHERE n <= 50""")
def indexed_search(t):
    """Search by stored gram indexes of customers and parts, after a batch that renames customers and takes some out."""
    k = F.col("c_custkey")
    folder = shared_dir(t.spark, "gram-index")
    people = GramIndex.build(t.customer, "c_custkey", ["c_name"], "c_name", f"{folder}/customer", 16)
    people.add(t.customer.filter("c_custkey % 10 = 0 or c_custkey % 11 = 0").select("c_custkey", F.when(k % 11 != 0, F.concat(F.lit("Ürne gone "), k.cast("string"))).alias("c_name")), "c_custkey")
    parts = GramIndex.build(t.part, "p_partkey", ["p_name", "p_brand"], "p_name", f"{folder}/part", 16)
    out = None
    for term in TERMS:
        one = search_all({"customer": people, "part": parts}, term, 50).select(F.lit(term).alias("term"), "kind", "id", "label")
        out = one if out is None else out.unionByName(one)
    return out


_STAR = """WITH o AS (
  SELECT o_orderkey AS seq, o_orderpriority AS organization, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS program, CASE WHEN o_orderkey % 50 <> 7 THEN year(o_orderdate) END AS fiscal_year,
         'Customer ' || (o_custkey % 200) AS awardee, CASE WHEN o_orderkey % 40 <> 3 THEN 'Work ' || (o_custkey % 3) ELSE '' END AS title,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 'http://x/' || o_custkey END AS source_url FROM orders),
r AS (SELECT * REPLACE (coalesce(program, 'general') AS program) FROM o WHERE fiscal_year IS NOT NULL),
old AS (SELECT organization, program, fiscal_year, awardee, title FROM r WHERE seq % 3 = 0 AND title <> '' AND organization < '4' GROUP BY ALL),
n AS (SELECT organization, program, fiscal_year, awardee, title, arg_max(amount, seq) AS amount, arg_max(source_url, seq) AS source_url FROM r WHERE title <> '' GROUP BY ALL),
f AS (SELECT organization, program, fiscal_year, awardee, title, CASE WHEN old.awardee IS NULL THEN n.amount ELSE coalesce(n.amount, 1.0) END AS amount, CASE WHEN o2 THEN coalesce(n.source_url, 'old') ELSE n.source_url END AS source_url
      FROM n LEFT JOIN (SELECT *, true AS o2 FROM old) old USING (organization, program, fiscal_year, awardee, title)) """


def star(t):
    """Orders as award records, and a star that holds a part of them from before."""
    k = F.col("o_orderkey")
    records = t.orders.select(
        k.alias("seq"), F.col("o_orderpriority").alias("organization"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("program"), F.when(k % 50 != 7, F.year("o_orderdate")).alias("fiscal_year"),
        F.concat(F.lit("　Customer "), (F.col("o_custkey") % 200).cast("string")).alias("awardee"), F.when(k % 40 != 3, F.concat(F.lit("Work "), (F.col("o_custkey") % 3).cast("string"))).alias("title"),
        F.when(k % 5 != 0, F.col("o_totalprice")).alias("amount"), F.when(k % 2 == 0, F.concat(F.lit("http://x/"), F.col("o_custkey").cast("string"))).alias("source_url"),
    )
    old = records.filter("seq % 3 = 0 and title is not null and fiscal_year is not null and organization < '4'").withColumns({"program": F.coalesce("program", F.lit("general")), "awardee": F.ltrim(F.translate("awardee", "　", ""))})
    key = lambda *c: F.concat_ws("/", F.lit("old"), *[F.col(x).cast("string") for x in c])
    org, prog, call = key("organization"), key("organization", "program"), key("organization", "program", "fiscal_year")
    tables = {
        "organisations": old.select(org.alias("id"), F.col("organization").alias("name")).distinct(),
        "programs": old.select(prog.alias("id"), org.alias("organization_id"), F.col("program").alias("name")).distinct(),
        "calls": old.select(call.alias("id"), prog.alias("program_id"), "fiscal_year").distinct(),
        "results": old.select(key("organization", "program", "fiscal_year", "awardee", "title").alias("id"), call.alias("call_id"), "awardee", "title").distinct().withColumns({"amount": F.lit(1.0), "source_url": F.lit("old")}),
    }
    return tables, records


@query(_STAR + "SELECT organization, program, CAST(fiscal_year AS INTEGER) AS fiscal_year, awardee, title, round(amount, 2) AS amount, source_url, organization < '4' AS old_org FROM f")
def star_results(t):
    """Award records entered into organisations, programmes, calls and results in one run, joined again by their ids."""
    new, _ = U.upsert_star(*star(t))
    o = new["organisations"].select(F.col("id").alias("organization_id"), F.col("name").alias("organization"))
    p = new["programs"].select(F.col("id").alias("program_id"), "organization_id", F.col("name").alias("program"))
    c = new["calls"].select(F.col("id").alias("call_id"), "program_id", "fiscal_year")
    rows = new["results"].join(c, "call_id").join(p, "program_id").join(o, "organization_id")
    return rows.select("organization", "program", "fiscal_year", "awardee", "title", F.round("amount", 2).alias("amount"), "source_url", F.startswith("organization_id", F.lit("old/")).alias("old_org"))


@query(_STAR + """, x AS (SELECT 'organisations' AS name, (SELECT count(DISTINCT organization) FROM r) AS wanted, (SELECT count(DISTINCT organization) FROM old) AS found
UNION ALL SELECT 'programs', (SELECT count(*) FROM (SELECT DISTINCT organization, program FROM r)), (SELECT count(*) FROM (SELECT DISTINCT organization, program FROM old))
UNION ALL SELECT 'calls', (SELECT count(*) FROM (SELECT DISTINCT organization, program, fiscal_year FROM r)), (SELECT count(*) FROM (SELECT DISTINCT organization, program, fiscal_year FROM old))
UNION ALL SELECT 'results', (SELECT count(*) FROM n), (SELECT count(*) FROM old))
SELECT name, wanted - found AS inserted, found, 0 AS untouched FROM x""")
def star_plan(t):
    return U.upsert_star(*star(t))[1]
