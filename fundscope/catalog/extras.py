"""Places, eligibility, scores and registered SQL functions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import eligibility, places, scores
from ..functions.register import register_functions
from ..operators import rules as R
from .registry import query


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_mktsegment LIKE '%U%' AND NOT c_mktsegment LIKE '%B%' THEN 'exec' WHEN c_mktsegment LIKE '%B%' THEN 'advisor' ELSE 'none' END AS relation FROM customer""")
def corporate_relation(t):
    c = F.col
    return t.customer.select("c_custkey", eligibility.corporate_relation(c("c_acctbal") > 0, c("c_name"), c("c_mktsegment"), c("c_name"), ["U"], ["B"]).alias("relation"))


@query("""SELECT p_partkey, (p_name <> '')::INT * 50 + (p_brand LIKE '%1%')::INT * 40 + (p_type <> '')::INT * 20 AS richness FROM part""")
def richness(t):
    c = F.col
    return t.part.select("p_partkey", scores.richness([(c("p_name"), 50), (F.when(F.contains("p_brand", F.lit("1")), c("p_brand")), 40), (c("p_type"), 20)]).alias("richness"))


@query("""WITH s AS (SELECT p_brand, p_partkey, p_name, CASE WHEN contains(p_name, 'ring') THEN 10 ELSE 0 END + CASE WHEN contains(p_name, 'bolt') THEN 3 ELSE 0 END + 2 * (contains(p_name, 'widget')::INT + contains(p_name, 'gear')::INT) + CASE WHEN contains(p_name, 'hot') THEN -5 ELSE 0 END AS score FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS k FROM s WHERE score > 0) SELECT p_brand, p_partkey, score FROM r WHERE k = 1""")
def title_pick(t):
    keys = F.array(F.lit("widget"), F.lit("gear"), F.lit("ho"))
    s = t.part.select("p_brand", "p_partkey", scores.title_score(F.col("p_name"), F.lit("ring"), keys, ["bolt"], "hot").alias("score"))
    return scores.best_title(s, "p_brand", "p_partkey", "score")


@query()
def url_pick(t):
    """Greedy by rounds, rivals for a root resolved by id."""
    links = t.pages.select((F.col("page_id") % 40).alias("id"), F.col("page_id").alias("place"), "url")
    return scores.pick_urls(links, t.spark.createDataFrame([("example.org",)], "domain string"), ["th"])


@query("""SELECT s_suppkey, list_aggregate(list_filter([CASE WHEN contains(s_name, '1') THEN 'ichi' END, lower(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g'))], lambda x: x IS NOT NULL AND length(x) BETWEEN 3 AND 30), 'string_agg', ',') AS cores FROM supplier""")
def latin_cores(t):
    return t.supplier.select("s_suppkey", F.array_join(scores.latin_core(F.col("s_name"), {"1": "ichi"}), ",").alias("cores"))


@query("""SELECT user_id, nullif(list_aggregate(list_slice(list_sort(list_distinct(list_filter(list(CASE event_type WHEN 'view' THEN 'sight' WHEN 'error' THEN 'fault' END), lambda x: x IS NOT NULL))), 1, 3), 'string_agg', ','), '') AS fields FROM events GROUP BY user_id""")
def field_inference(t):
    g = t.events.groupBy("user_id").agg(F.collect_set("event_type").alias("k"))
    return g.select("user_id", F.nullif(F.array_join(scores.inferred_fields(F.col("k"), F.lit(""), {"view": "sight", "error": "fault"}, {"zzz": "x"}), ","), F.lit("")).alias("fields"))


@query("""SELECT count(*) FILTER (contains(text, 'nd')) AS research, count(*) FILTER (contains(text, 'nd') AND contains(text, 'eaux')) AS corporate, sum(contains(text, 'nd')::INT + contains(text, 'th')::INT)::BIGINT AS score FROM documents""")
def research_flags(t):
    c = F.col("text")
    score = R.distinct_hits(c, R.Rule("r", ("nd", "th")))
    return t.documents.agg(F.count_if(F.contains(c, F.lit("nd"))).alias("research"), F.count_if(F.contains(c, F.lit("nd")) & F.contains(c, F.lit("eaux"))).alias("corporate"), F.sum(score).alias("score"))


@query("""SELECT o_orderstatus, count(*) AS n, list_sort(list(o_totalprice))[CAST(count(*) // 2 + 1 AS BIGINT)] AS upper, min(year(o_orderdate) - (month(o_orderdate) < 4)::INT) AS first_fy FROM orders GROUP BY 1""")
def sql_functions(t):
    register_functions(t.spark)
    t.orders.createOrReplaceTempView("fs_orders")
    return t.spark.sql("SELECT o_orderstatus, count(*) AS n, fs_upper_median(collect_list(o_totalprice)) AS upper, min(fs_fiscal_year(CAST(o_orderdate AS DATE))) AS first_fy FROM fs_orders GROUP BY 1")


@query(r"""SELECT page_id, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]+"[^>]*>.*?</a>')) FROM pages) GROUP BY page_id""")
def parse_udtf(t):
    register_functions(t.spark)
    t.pages.createOrReplaceTempView("fs_pages")
    return t.spark.sql("SELECT page_id, count(*) AS links FROM fs_pages, LATERAL fs_links(html) GROUP BY page_id")
