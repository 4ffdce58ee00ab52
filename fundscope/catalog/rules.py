"""Keyword rules over documents.  The rule sets are small ones for the invented words of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import rules as R
from .registry import query

RULES = [R.Rule("greeting", ("thion", "the the")), R.Rule("german", ("nicht", "lichen", "schen")), R.Rule("french", ("eaux", "elle")), R.Rule("spanish", ("ción", "que"))]


def _first() -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f"contains(text, '{w}')" for w in r.keywords)} THEN '{r.label}'" for r in RULES) + " END"


def _hits(r: R.Rule) -> str:
    return " + ".join(f"contains(text, '{w}')::INT" for w in r.keywords)


def _best() -> str:
    top = f"greatest({', '.join(_hits(r) for r in RULES)})"
    return f"CASE WHEN {top} = 0 THEN NULL " + " ".join(f"WHEN ({_hits(r)}) = {top} THEN '{r.label}'" for r in RULES) + " END"


def _weight(r: R.Rule) -> str:
    return " + ".join(f"(length(text) - length(replace(text, '{w}', '')))::DOUBLE / {len(w)} * {min(len(w), 6)}" for w in r.keywords)


@query(f"SELECT doc_id, {_first()} AS label FROM documents")
def kw_first(t):
    return t.documents.select("doc_id", R.first_match(F.col("text"), RULES).alias("label"))


@query(f"SELECT doc_id, {_best()} AS label FROM documents")
def kw_argmax(t):
    return t.documents.select("doc_id", R.most_hits(F.col("text"), RULES).alias("label"))


@query("SELECT doc_id, list_aggregate(list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f"contains(text, '{w}')" for w in r.keywords)} THEN '{r.label}' END" for r in RULES) + "], lambda x: x IS NOT NULL), 'string_agg', ',') AS labels FROM documents")
def kw_multi(t):
    return t.documents.select("doc_id", F.nullif(F.array_join(R.all_matches(F.col("text"), RULES), ","), F.lit("")).alias("labels"))


@query("WITH s AS (SELECT doc_id, unnest([" + ", ".join(f"{{'s': {_weight(r)}, 'k': {k}, 'label': '{r.label}'}}" for k, r in enumerate(RULES)) + "], recursive := true) FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, k) AS n FROM s WHERE s > 0) SELECT doc_id, string_agg(label, ',' ORDER BY n) AS labels FROM r WHERE n <= 3 GROUP BY doc_id")
def kw_weighted(t):
    # a filter on the labels would evaluate them a second time
    some = F.explode(F.filter(F.array(R.weighted(F.col("text"), RULES)), lambda x: F.size(x) > 0)).alias("x")
    return t.documents.select("doc_id", some).select("doc_id", F.array_join("x", ",").alias("labels"))


LEVELS = [("en", "en/a", "en/a/1", ("the", "thion")), ("en", "en/a", "en/a/2", ("that", "nd")), ("en", "en/b", "en/b/1", ("ough",)), ("de", "de/a", "de/a/1", ("und", "sch", "lichen")), ("fr", "fr/a", "fr/a/1", ("les", "eaux")), ("es", "es/a", "es/a/1", ("ción",))]


@query("WITH r(ord, domain, l1, l2, keyword) AS (VALUES " + ", ".join(f"({k}, '{d}', '{a}', '{b}', '{w}')" for k, (d, a, b, words) in enumerate(LEVELS) for w in words) + """),
m AS (SELECT doc_id, ord, domain, l1, l2, count(*) AS s FROM documents JOIN r ON contains(text, keyword) GROUP BY ALL),
x AS (SELECT doc_id, domain, sum(s) AS s, min(ord) AS o FROM m GROUP BY 1, 2), y AS (SELECT doc_id, l1, sum(s) AS s, min(ord) AS o FROM m GROUP BY 1, 2), z AS (SELECT doc_id, l2, sum(s) AS s, min(ord) AS o FROM m GROUP BY 1, 2),
d AS (SELECT doc_id, string_agg(domain, ',' ORDER BY s DESC, o) AS domains FROM x GROUP BY 1), e AS (SELECT doc_id, string_agg(l1, ',' ORDER BY s DESC, o) AS fields FROM y GROUP BY 1), f AS (SELECT doc_id, string_agg(l2, ',' ORDER BY s DESC, o) AS subfields FROM z GROUP BY 1)
SELECT doc_id, coalesce(domains, 'unclassified') AS domains, coalesce(fields, '') AS fields, coalesce(subfields, '') AS subfields FROM documents LEFT JOIN d USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN f USING (doc_id)""")
def kw_hierarchy(t):
    rows = [("levels", k, d, a, b, w) for k, (d, a, b, words) in enumerate(LEVELS) for w in words]
    rules = R.rule_table(t.spark.createDataFrame(rows, "ruleset string, ord int, domain string, l1 string, label string, keyword string"), "levels")
    m = R.long_matches(t.documents, "doc_id", "text", rules)
    m = m.join(F.broadcast(rules.select("ord", "domain", "l1", "label").distinct()), "ord")
    x = R.hierarchy_scores(m, "doc_id", ["domain", "l1", "label"], t.documents)
    shown = lambda c: F.array_join(c, ",")
    return x.select("doc_id", F.when(F.size("domain") == 0, "unclassified").otherwise(shown("domain")).alias("domains"), shown("l1").alias("fields"), shown("label").alias("subfields"))


@query(f"SELECT doc_id, {_first()} AS label FROM documents")
def kw_from_table(t):
    """The first rule of a rule table."""
    rows = [("x", k, r.label, w, 1.0) for k, r in enumerate(RULES) for w in r.keywords] + [("other", 0, "no", "a", 1.0), ("x", 9, "blank", "", 1.0)]
    rules = R.rules_from(t.spark.createDataFrame(rows, "ruleset string, ord int, label string, keyword string, weight double"), "x")
    return t.documents.select("doc_id", R.first_match(F.col("text"), rules).alias("label"))


@query(f"SELECT d.doc_id, coalesce(CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'bad' END, {_first()}, 'unclassified') AS label, CASE WHEN l.quality IS NOT NULL THEN 'curated' WHEN {_first()} IS NOT NULL THEN 'keyword' ELSE 'none' END AS method FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def evidence_hybrid(t):
    curated = t.labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    keyword = t.documents.select("doc_id", R.first_match(F.col("text"), RULES).alias("label"))
    return R.evidence_first(curated, "doc_id", [F.col("label")], keyword).withColumn("label", F.coalesce("label", F.lit("unclassified")))


@query("""WITH m AS (SELECT doc_id, unnest(list_filter([CASE WHEN contains(text, 'thion') THEN 'a' END, CASE WHEN contains(text, 'nd') THEN 'b' END, CASE WHEN contains(text, 'eaux') THEN 'c' END], lambda x: x IS NOT NULL)) AS label, CASE WHEN n_chars BETWEEN 0 AND 3000 THEN n_chars ELSE 0 END AS a FROM documents)
SELECT label, count(*) AS n, sum(a)::DOUBLE AS total, CAST(floor(avg(a) FILTER (a > 0)) AS BIGINT) AS average FROM m GROUP BY label""")
def multi_member(t):
    rules = [R.Rule("a", ("thion",)), R.Rule("b", ("nd",)), R.Rule("c", ("eaux",))]
    d = t.documents.select("doc_id", R.all_matches(F.col("text"), rules).alias("labels"), "n_chars")
    return A.multi_member(d, "doc_id", "labels", "n_chars", 3000).withColumn("total", F.col("total").cast("double"))


@query("""SELECT p_partkey, CASE WHEN p_type LIKE '%BRASS%' OR lower(p_type) LIKE '%brass%' THEN 'metal' WHEN p_size < 10 THEN 'small' WHEN p_retailprice > 1500 THEN 'dear' ELSE 'other' END AS label FROM part""")
def decision_list(t):
    c = F.col
    return t.part.select("p_partkey", R.decision([(F.contains(F.lower("p_type"), F.lit("brass")), "metal"), (c("p_size") < 10, "small"), (c("p_retailprice") > 1500, "dear")], "other").alias("label"))


_SCORED = """WITH f AS (SELECT p_partkey, (p_size < 10)::INT * 3.0 + (p_retailprice < 1200)::INT * 2.0 AS a, (p_retailprice >= 1200)::INT * 2.0 + (p_size >= 30)::INT * 2.0 AS b0 FROM part),
s AS (SELECT p_partkey, a, b0 + CASE WHEN a = 0 THEN 1.5 ELSE 0 END AS b FROM f)
SELECT p_partkey, CASE WHEN abs(a - b) >= 1 THEN CASE WHEN a >= b THEN 'light' ELSE 'heavy' END ELSE 'other' END AS label, CASE WHEN abs(a - b) >= 3 THEN 'high' WHEN abs(a - b) >= 1 THEN 'medium' ELSE 'low' END AS confidence, greatest(a, b)::DOUBLE AS score FROM s"""


@query(_SCORED)
def evidence_scorer(t):
    c = F.col
    evidence = [
        R.Evidence("light", 3, "size", c("p_size") < 10),
        R.Evidence("light", 2, "price", c("p_retailprice") < 1200),
        R.Evidence("heavy", 2, "price", c("p_retailprice") >= 1200),
        R.Evidence("heavy", 2, "size", c("p_size") >= 30),
        R.Evidence("heavy", 1.5, "nothing light", after=lambda s: s["light"] == 0),
    ]
    return t.part.select("p_partkey", R.evidence_score(["light", "heavy"], evidence, (3, 1), "other").alias("x")).select("p_partkey", "x.label", "x.confidence", "x.score")


@query("""WITH b AS (SELECT doc_id, lang, CASE WHEN contains(text, 'thion') THEN 'a' WHEN contains(text, 'eaux') THEN 'b' END AS theme FROM documents WHERE lang IN ('en', 'fr'))
SELECT lang, coalesce(theme, 'unclassified') AS theme, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang)::BIGINT AS base FROM b GROUP BY 1, 2""")
def sub_theme(t):
    from pyspark.sql import Window

    theme = R.first_match(F.col("text"), [R.Rule("a", ("thion",)), R.Rule("b", ("eaux",))], "unclassified")
    d = t.documents.filter(F.col("lang").isin("en", "fr")).groupBy("lang", theme.alias("theme")).agg(F.count(F.lit(1)).alias("n"))
    return d.withColumn("base", F.sum("n").over(Window.partitionBy("lang")))


@query("""WITH s AS (SELECT conv_id, lower(text) AS t FROM conversations), c(code, kw) AS (VALUES ('x', 'th'), ('x', 'nd'), ('y', 'eaux'), ('z', 'ción'))
SELECT code, count(DISTINCT conv_id) AS conversations FROM s JOIN c ON contains(t, kw) GROUP BY code""")
def co_mention(t):
    rules = [R.Rule("x", ("th", "nd")), R.Rule("y", ("eaux",)), R.Rule("z", ("ción",))]
    c = t.conversations.select("conv_id", F.explode(R.all_matches(F.lower("text"), rules)).alias("code"))
    return c.groupBy("code").agg(F.countDistinct("conv_id").alias("conversations"))


@query("""SELECT s_suppkey, (s_acctbal > 0)::INT * 10 + (s_nationkey < 5)::INT * 50 + least(length(s_name), 20) AS score FROM supplier""")
def owner_score(t):
    c = F.col
    return t.supplier.select("s_suppkey", ((c("s_acctbal") > 0).cast("int") * 10 + (c("s_nationkey") < 5).cast("int") * 50 + F.least(F.char_length("s_name"), F.lit(20))).alias("score"))
