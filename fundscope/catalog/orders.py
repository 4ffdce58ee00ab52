"""Order-dependent operators, top-k, and document layouts on the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import documents as D
from ..operators import windows as W
from ..streaming import ingest
from .registry import query


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1")
def first_per_key(t):
    return W.first_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_totalprice > 200000)::INT + (o_orderpriority = '1-URGENT')::INT DESC, o_orderkey) = 1 AS is_best, count(*) OVER (PARTITION BY o_custkey) AS group_size FROM orders""")
def best_of(t):
    score = (F.col("o_totalprice") > 200000).cast("int") + (F.col("o_orderpriority") == "1-URGENT").cast("int")
    return W.best_and_drops(t.orders, ["o_custkey"], [F.desc(score), F.col("o_orderkey")]).select("o_orderkey", "is_best", "group_size")


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END DESC NULLS LAST, o_orderkey) AS k FROM orders) WHERE k = 1""")
def latest(t):
    d = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return W.first_per_key(t.orders, ["o_custkey"], [d.desc_nulls_last(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT c_nationkey, c_custkey, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k <= 3")
def topk_group(t):
    return A.top_k(t.customer, ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey", "rank")


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier")
def rank(t):
    return t.supplier.select("s_suppkey", F.row_number().over(Window.orderBy(F.desc("s_acctbal"), "s_suppkey")).cast("long").alias("rank"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked_at FROM conversations""")
def carry_forward(t):
    return t.conversations.select("conv_id", "turn", W.carried(F.when(F.col("role") == "user", F.col("turn")), ["conv_id"], [F.col("turn")]).alias("asked_at"))


@query("""SELECT conv_id, turn, CASE WHEN nr = 'assistant' THEN nt END AS answer FROM (SELECT conv_id, turn, role, lead(role) OVER w AS nr, lead(length(text)) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user'""")
def pair_rows(t):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = t.conversations.withColumns({"nr": F.lead("role").over(w), "nt": F.lead(F.char_length("text")).over(w)}).filter("role = 'user'")
    return c.select("conv_id", "turn", F.when(F.col("nr") == "assistant", F.col("nt").cast("long")).alias("answer"))


@query("""SELECT event_id, list_aggregate(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING), 'string_agg', ',') AS around, coalesce(list_aggregate(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 'string_agg', ','), '') AS ahead FROM events""")
def frame_ctx(t):
    by, order = ["user_id"], [F.col("ts"), F.col("event_id")]
    return t.events.select("event_id", F.array_join(W.around(F.col("event_type"), by, order, 4, 5), ",").alias("around"), F.array_join(W.next_rows(F.col("event_type"), by, order, 3), ",").alias("ahead"))


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, CAST(round(sum(o_totalprice)) AS BIGINT) AS v FROM orders GROUP BY 1, 2)
SELECT o_custkey, string_agg(y || ':' || v, ',' ORDER BY y DESC) AS history, max_by(v, y) AS current FROM y GROUP BY 1""")
def history_arr(t):
    # sums of doubles at a half depend on the order of addition: rows are added by their key, as they are stored
    by = Window.partitionBy("o_custkey", "y").orderBy("o_orderkey")
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey", "o_totalprice")
    o = o.withColumns({"sum": F.sum("o_totalprice").over(by.rowsBetween(Window.unboundedPreceding, 0)), "k": F.row_number().over(by)})
    y = o.groupBy("o_custkey", "y").agg(F.round(F.max_by("sum", "k")).cast("long").alias("v"))
    h = W.history(y, "o_custkey", "y", "v")
    return h.select("o_custkey", F.array_join(F.transform("history", lambda x: F.concat(x["year"].cast("string"), F.lit(":"), x["value"].cast("string"))), ",").alias("history"), "current")


@query("""SELECT l_orderkey, cnt AS n FROM (SELECT l_orderkey, nullif(l_linenumber, 1) AS ln, count(*) AS cnt FROM lineitem GROUP BY 1, 2) WHERE cnt > 1 AND ln IS NULL""")
def dedup_composite(t):
    w = Window.partitionBy("l_orderkey", F.nullif("l_linenumber", F.lit(1)))
    x = t.lineitem.withColumns({"n": F.count(F.lit(1)).over(w), "ln": F.nullif("l_linenumber", F.lit(1))})
    kept = W.first_per_key(x, ["l_orderkey", "ln"], [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")])
    return kept.filter("n > 1 and ln is null").select("l_orderkey", "n")


@query("SELECT doc_id FROM documents ORDER BY nullif(source, 'src0') DESC NULLS LAST, n_chars DESC, doc_id LIMIT 25")
def nulls_last_order(t):
    return t.documents.orderBy(F.nullif("source", F.lit("src0")).desc_nulls_last(), F.desc("n_chars"), "doc_id").limit(25).select("doc_id")


@query("SELECT o_orderkey FROM orders ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey LIMIT 30")
def priority_order(t):
    p = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return t.orders.orderBy(p, F.desc("o_totalprice"), "o_orderkey").limit(30).select("o_orderkey")


@query("SELECT c_custkey FROM customer ORDER BY CASE WHEN c_acctbal > 0 THEN -c_acctbal ELSE -c_nationkey END, c_custkey LIMIT 40")
def mixed_sort_key(t):
    return t.customer.orderBy(F.when(F.col("c_acctbal") > 0, -F.col("c_acctbal")).otherwise(-F.col("c_nationkey")), "c_custkey").limit(40).select("c_custkey")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def most_common(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def tumbling_counts(t):
    return ingest.windowed_counts(t.events, "ts", ["event_type"], "1 hour").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS cut FROM events), s AS (SELECT user_id, ts, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_counts(t):
    return ingest.sessions(t.events, "ts", ["user_id"], "30 minutes").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


def _cells(t):
    """Turns as table rows: a user's turn opens a section, an assistant's has three cells."""
    words = F.split("text", " ")
    cells = F.when(F.col("role") == "assistant", F.array(words[0], F.get(words, F.lit(1)), F.get(words, F.lit(2)))).otherwise(F.array(words[0]))
    return t.conversations.select(F.col("conv_id").alias("doc"), F.col("turn").alias("pos"), cells.alias("cells"))


@query()
def parse_sectioned(t):
    return D.parse("sectioned", _cells(t), header=F.size("cells") == 1)


@query()
def parse_paired(t):
    return D.parse("paired", _cells(t), is_first=F.size("cells") == 1)


@query()
def parse_anchored(t):
    lines = t.documents.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return D.parse("anchored", lines, anchor=F.char_length("text") < 30, header=F.col("text").rlike("^[A-Z !.,]+$"))


@query()
def parse_trailing_amounts(t):
    rows = t.orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("pos"), F.array(F.col("o_orderstatus"), F.col("o_orderpriority"), F.floor("o_totalprice").cast("string")).alias("cells"))
    return D.parse("trailing_amount", rows)


@query()
def parse_statement(t):
    lines = t.documents.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return D.parse("statement", lines, keywords=["token", "The", "In"], least=1000)
