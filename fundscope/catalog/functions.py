"""Scalar functions on the test tables: names, URLs, HTML, amounts, dates, JSON, arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import amounts as M
from ..functions import is_blank, names
from ..functions import structured as S
from ..functions import web
from ..sources import readers
from .registry import query


@query("SELECT page_id, regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.\\-]*://)?([^/?#]*)', 1), '^www\\.', '') AS host, regexp_replace(regexp_replace(lower(regexp_replace(trim(url), '/+$', '')), '/index\\.html?$', ''), 'x^', '') AS canonical FROM pages".replace("\\\\", "\\"))
def url_host(t):
    return t.pages.select("page_id", web.host(F.col("url")).alias("host"), web.canonical(F.col("url")).alias("canonical"))


@query(r"""WITH h AS (SELECT page_id, regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.\-]*://)?([^/?#]*)', 1), '^www\.', '') AS host FROM pages)
SELECT page_id, host FROM h WHERE NOT (host = 'example.org' OR ends_with(host, '.example.org') OR host = 'example.net' OR ends_with(host, '.example.net')) AND (ends_with(host, '.com') OR ends_with(host, '.org'))""")
def host_deny(t):
    h = t.pages.select("page_id", web.host(F.col("url")).alias("host"))
    denied = web.under(F.col("host"), F.lit("example.org")) | web.under(F.col("host"), F.lit("example.net"))
    return h.filter(~denied & (F.col("host").endswith(".com") | F.col("host").endswith(".org")))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_strip(t):
    return t.pages.select("page_id", web.strip_tags(F.col("html")).alias("text"))


@query(r"""SELECT page_id, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title, len(regexp_extract_all(html, '(?i)<p>')) AS paragraphs FROM pages""")
def html_cells(t):
    return t.pages.select("page_id", F.nullif(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1), F.lit("")).alias("title"), F.size(F.regexp_extract_all("html", F.lit("(?i)<p>"), F.lit(0))).cast("long").alias("paragraphs"))


@query(r"""SELECT page_id, CASE WHEN ends_with(h, '.or.jp') THEN 10 WHEN ends_with(h, '.go.jp') OR ends_with(h, '.ac.jp') THEN 8 WHEN ends_with(h, '.org') THEN 6 WHEN ends_with(h, '.jp') THEN 4 WHEN ends_with(h, '.com') THEN 2 ELSE 0 END + CASE WHEN regexp_replace(url, '^[a-z]+://[^/]*', '') IN ('', '/') THEN 3 ELSE 0 END AS trust
FROM (SELECT page_id, url, regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.\-]*://)?([^/?#]*)', 1), '^www\.', '') AS h FROM pages)""")
def url_trust(t):
    return t.pages.select("page_id", web.trust(F.col("url")).alias("trust"))


@query("""SELECT s_suppkey, list_aggregate(['https://' || lower(replace(s_name, '#', '')) || '.org', 'https://www.' || lower(replace(s_name, '#', '')) || '.com'], 'string_agg', ' ') AS urls FROM supplier""")
def url_candidates(t):
    core = F.array(F.lower(F.replace("s_name", F.lit("#"), F.lit(""))))
    return t.supplier.select("s_suppkey", F.array_join(web.candidate_urls(core, ["https://{}.org", "https://www.{}.com"]), " ").alias("urls"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed FROM documents".replace("\\\\", "\\"))
def nfkc(t):
    return t.documents.select("doc_id", names.squeezed(F.col("text")).alias("squeezed"))


@query("""SELECT c_custkey, lower(replace(replace(c_name, '　', ''), ' ', '')) AS import, regexp_replace(c_name, '\\s+', '', 'g') AS person, lower(regexp_replace(c_name, '[\\s・\\-_,，、。.／/]+', '', 'g')) AS verify FROM customer""".replace("\\\\", "\\"))
def name_profiles(t):
    n = lambda p: names.normalize_name(F.col("c_name"), p)
    return t.customer.select("c_custkey", n("import").alias("import"), n("person_ws").alias("person"), n("verify").alias("verify"))


@query()
def name_profiles_all(t):
    """Every profile over the part names: those that compose to NFKC have no SQL."""
    return t.part.select("p_partkey", *[names.normalize_name(F.col("p_name"), p).alias(p) for p in (*names.PROFILES, "dedup")])


@query("""SELECT o_orderkey, year(o_orderdate) - (month(o_orderdate) < 4)::INT AS fy, CASE WHEN o_orderdate < DATE '1997-06-01' AND o_orderstatus <> 'F' THEN 'closed' ELSE o_orderstatus END AS status FROM orders""")
def fiscal_year(t):
    d = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", M.fiscal_year(d).alias("fy"), F.when((d < F.lit("1997-06-01").cast("date")) & (F.col("o_orderstatus") != "F"), "closed").otherwise(F.col("o_orderstatus")).alias("status"))


@query("""SELECT doc_id, len(v) AS numbers, list_max(v) AS most FROM (SELECT doc_id, list_filter([CAST(x AS BIGINT) FOR x IN list_filter(regexp_split_to_array(text, '[^0-9.,]+'), lambda s: regexp_full_match(s, '[0-9]{4,13}'))], lambda x: x >= 1000) AS v FROM documents) WHERE len(v) > 0""")
def line_amounts(t):
    """Bare numbers of four and more digits; SQL sees them as whole tokens between other characters."""
    v = F.filter(F.flatten(F.transform(F.split("text", "[^0-9.,]+"), lambda s: F.when(s.rlike("^[0-9]{4,13}$"), M.line_amounts(s, 1000)).otherwise(F.array().cast("array<long>")))), lambda x: x.isNotNull())
    return t.documents.select("doc_id", v.alias("v")).filter(F.size("v") > 0).select("doc_id", F.size("v").cast("long").alias("numbers"), F.array_max("v").alias("most"))


@query("""SELECT o_orderkey, abs(o_totalprice - 150000) / 150000 <= 0.05 AS near, CASE WHEN o_totalprice >= 300000 THEN NULL ELSE o_totalprice END AS amount, CASE WHEN o_totalprice >= 300000 THEN 'total_only' ELSE 'per_award' END AS kind FROM orders""")
def amount_gates(t):
    none = F.lit(None).cast("double")
    x = M.isolate_total(none, F.col("o_totalprice"), F.lit(2), F.lit(""), F.lit(""), floor=300_000)
    return t.orders.select("o_orderkey", M.close_to(F.col("o_totalprice"), F.lit(150000)).alias("near"), x["amount"].alias("amount"), x["kind"].alias("kind"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, contains(props, '"k"') AS has_k FROM events""")
def json_path(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.contains("props", F.lit('"k"')).alias("has_k"))


@query("""SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def json_group(t):
    return t.events.groupBy(F.get_json_object("props", "$.k").try_cast("long").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT event_id FROM events ORDER BY coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) DESC, event_id LIMIT 20""")
def json_sort_default(t):
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(0))
    return t.events.orderBy(F.desc(k), "event_id").limit(20).select("event_id")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, '["a","' || event_type || '"]' AS sources FROM events WHERE event_type > 'a'""")
def json_merge(t):
    left = F.map_concat(S.as_map(F.col("props")), F.create_map(F.lit("source"), F.col("event_type")))
    right = S.as_map(F.lit('{"k": "none", "sources": "[\\"a\\"]"}'))
    m = S.merged(left, right)
    return t.events.filter("event_type > 'a'").select("event_id", m["k"].alias("k"), m["sources"].alias("sources"))


@query("""SELECT user_id, substring(string_agg(DISTINCT event_type, ', ' ORDER BY event_type), 1, 400) AS joined, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS csv FROM events GROUP BY user_id""")
def array_joins(t):
    g = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    return g.select("user_id", S.joined(F.col("k")).alias("joined"), S.csv_union(F.array_join("k", ","), F.array_join(F.reverse("k"), " , ")).alias("csv"))


@query("""WITH x AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS k FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id)
SELECT user_id, unnest(k) AS label, CASE WHEN generate_subscripts(k, 1) = 1 THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END AS weight FROM x""")
def weighted_labels(t):
    g = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    return g.select("user_id", F.explode(S.weighted_labels(F.col("k"), ["click", "view", "purchase"])).alias("x")).select("user_id", "x.label", "x.weight")


@query("SELECT c_custkey, 'org_' || substring(sha256(c_name || chr(31) || c_mktsegment), 1, 12) AS id FROM customer")
def stable_ids(t):
    return t.customer.select("c_custkey", S.stable_id("org_", F.col("c_name"), F.col("c_mktsegment")).alias("id"))


@query("""SELECT c_custkey, CASE WHEN c_name NOT LIKE '%1%' THEN c_name END AS kept, (CASE WHEN c_name LIKE '%1%' THEN '' ELSE c_name END) = '' AS blank FROM customer""")
def blanks(t):
    name = F.when(~F.contains("c_name", F.lit("1")), F.col("c_name")).otherwise("")
    return t.customer.select("c_custkey", F.nullif(name, F.lit("")).alias("kept"), is_blank(name).alias("blank"))


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '[\w.+-]+@[\w-]+\.[\w.-]+')) AS mails FROM documents WHERE regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.-]+')""")
def entity_context(t):
    hits = web.with_context(F.col("text"), r"[\w.+-]+@[\w-]+\.[\w.-]+", 100)
    return t.documents.select("doc_id", F.size(hits).cast("long").alias("mails")).filter("mails > 0")


@query("""WITH w AS (SELECT source, lower(w) AS word, count(DISTINCT doc_id) AS n FROM (SELECT source, doc_id, unnest(regexp_extract_all(text, '[a-z]{6,15}')) AS w FROM documents) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS k FROM w WHERE word NOT IN ('mentre', 'lichen'))
SELECT source, string_agg(word, ',' ORDER BY k) AS keywords FROM r WHERE k <= 8 GROUP BY source""")
def keyword_extraction(t):
    from ..operators import aggregates as A

    each = t.documents.select("source", "doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]{6,15}"), F.lit(0)))).alias("word"))
    counts = each.filter(~F.col("word").isin("mentre", "lichen")).groupBy("source", "word").agg(F.count(F.lit(1)).alias("n"))
    top = A.top_k(counts, ["source"], [F.desc("n"), F.col("word")], 8)
    return top.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), ",").alias("keywords"))


@query()
def page_lines(t):
    return readers.page_text(t.documents.select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), "text")).select("doc", "page", "line", F.char_length("text").alias("n"))
