import pytest
from pyspark.sql import functions as F

from fundscope import schemas
from fundscope.operators import aggregates as A
from fundscope.operators import checks, documents, matching, merging, rules, windows
from fundscope.plans import views
from fundscope.sources import readers, writers
from fundscope.streaming import ingest


def test_concentration_and_medians(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "k string, n int")
    r = A.hhi(df).first()
    assert (r.hhi, r.members, r.top_share) == (6250.0, 2, 0.75)
    assert A.hhi(df.limit(0)).first().hhi == 0
    x = spark.createDataFrame([(v,) for v in (4, 1, 3, 2)], "v int")
    assert x.agg(A.upper_median("v").alias("u"), F.median("v").alias("m")).first() == (3, 2.5)


def test_histogram_has_empty_buckets(spark, rows):
    df = spark.createDataFrame([(1.0,), (None,), (9.0,)], "v double")
    assert rows(A.histogram(df, F.col("v"), [(2, "low"), (5, "mid"), (None, "high")]), "bucket", "n") == [("high", 1), ("low", 1), ("mid", 0)]


def test_multi_member_counts_a_row_once_per_label(spark, rows):
    df = spark.createDataFrame([(1, ["a", "a", "b"], 10.0), (2, ["a"], 99.0), (3, ["b"], None)], "id int, ls array<string>, v double")
    assert rows(A.multi_member(df, "id", "ls", "v", 50)) == [("a", 2, 10.0, 10), ("b", 2, 10.0, 10)]


def test_rank_zip_uses_each_side_once(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, ""), (5, None)], "lid int, name string")
    right = spark.createDataFrame([(10, "a"), (11, "a"), (12, "a"), (13, "")], "rid int, name string")
    assert rows(matching.rank_zip(left, right, "name", "lid", "rid")) == [(1, 10), (2, 11)]


def test_tiers_are_one_to_one(spark, rows):
    left = spark.createDataFrame([(1, "alpha", "h1"), (2, "betagamma", ""), (3, "zeta", "h9"), (4, "gamm", "agg"), (5, "omegalong", "")], "lid int, name string, host string")
    right = spark.createDataFrame([(1, "alpha", "h9"), (2, "other", "h9"), (3, "gamma", "agg"), (4, "omega", "")], "rid int, name string, host string")
    got = rows(matching.tiered(left, right, ["agg"]))
    assert got == [(1, 1, "name", 0.95), (2, 3, "contains", 0.7), (3, 2, "host", 0.85), (5, 4, "contains", 0.7)]


def test_homonyms(spark, rows):
    people = spark.createDataFrame([(1, "u", None), (2, "h", "東京大学医学部"), (3, "h", "北海道大学"), (4, "h", "")], "pid int, name string, inst string")
    index = spark.createDataFrame([(7, "u", "x"), (8, "h", "東京大学"), (9, "h", "京都大学"), (10, "h", None)], "xid int, name string, inst string")
    assert rows(matching.homonyms(people, index)) == [(1, 7, "unique"), (2, 8, "institution")]
    # with blanks agreeing, the second person has two candidates
    assert (2, 8, "institution") not in rows(matching.homonyms(people, index, parity=True))


def test_containment_join_equals_a_nested_loop(spark, rows):
    s = [(1, "abcd"), (2, "bcde"), (3, "abc"), (4, "zzzz")]
    long = [(1, "xxabcdexx"), (2, "abcd"), (3, "q"), (4, None)]
    got = rows(matching.contained_pairs(spark.createDataFrame(s, "short_id int, s string"), spark.createDataFrame(long, "long_id int, t string")))
    assert got == sorted((i, j) for i, a in s for j, b in long if b and len(a) >= 4 and a in b)


def test_loose_fallback(spark, rows):
    s = spark.createDataFrame([(1, "exact"), (2, "longer name"), (3, "longer name too")], "sid int, key string")
    t = spark.createDataFrame([(1, "exact"), (2, "longer")], "tid int, key string")
    assert rows(matching.loose_fallback(s, t)) == [(1, 1, "exact"), (2, 2, "contains")]


def test_upsert_is_idempotent_and_keeps_old_values(spark, rows):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "id int, x string, y int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id int, x string, y int")
    out, plan = merging.upsert(cur, new, ["id"], ["x", "y"])
    assert rows(out) == [(1, "a", 1), (2, "b", 5), (3, "c", 6)]
    assert tuple(plan.first()) == (1, 1, 1)
    assert rows(merging.upsert(out, new, ["id"], ["x", "y"])[0]) == rows(out)


def test_replace_and_absorb_are_idempotent(spark, rows):
    cur = spark.createDataFrame([(1, "s1", "x"), (2, "s2", "y")], "id int, src string, v string")
    new = spark.createDataFrame([(3, "s1", "z")], "id int, src string, v string")
    once = merging.replace_slices(cur, new, ["src"])
    assert rows(once) == rows(merging.replace_slices(once, new, ["src"])) == [(2, "s2", "y"), (3, "s1", "z")]
    dup = spark.createDataFrame([(1, "k", "", 5), (2, "k", "v", 3), (3, "m", None, 1)], "id int, g string, v string, s int")
    best, gone = merging.absorb_duplicates(dup, F.col("g"), [F.desc("s")], "id", ["v"])
    assert rows(best, "id", "v") == [(1, "v"), (3, None)] and rows(gone) == [(2, 1)]
    child = spark.createDataFrame([(1, "c"), (2, "c"), (2, "d")], "id int, cat string")
    assert rows(merging.repoint(child, gone, "id", ["id", "cat"])) == [(1, "c"), (1, "d")]


def test_fill_blanks_treats_zero_as_missing_on_request(spark, rows):
    cur = spark.createDataFrame([(1, "", 0), (2, "b", 7)], "id int, x string, y int")
    new = spark.createDataFrame([(1, "n", 5), (2, "n", 5)], "id int, x string, y int")
    assert rows(merging.fill_blanks(cur, new, "id", ["x", "y"])) == [(1, "n", 0), (2, "b", 7)]
    assert rows(merging.fill_blanks(cur, new, "id", ["x", "y"], zero_too=True)) == [(1, "n", 5), (2, "b", 7)]


RULES = [rules.Rule("one", ("aa", "bb")), rules.Rule("two", ("cc",)), rules.Rule("three", ("bb", "dd"))]


def test_keyword_semantics_differ(spark):
    df = spark.createDataFrame([("aa cc",), ("bb dd",), ("cccc bb",), ("none",), (None,)], "t string")
    c = F.col("t")
    got = df.select(rules.first_match(c, RULES).alias("f"), rules.most_hits(c, RULES).alias("m"), rules.all_matches(c, RULES).alias("a"), rules.weighted(c, RULES).alias("w")).collect()
    assert [r.f for r in got] == ["one", "one", "one", None, None]
    assert [r.m for r in got] == ["one", "three", "one", None, None]
    assert [r.a for r in got] == [["one", "two"], ["one", "three"], ["one", "two", "three"], [], []]
    assert [r.w for r in got][:4] == [["one", "two"], ["three", "one"], ["two", "one", "three"], []]


def test_windows(spark, rows):
    df = spark.createDataFrame([(1, 1, "H"), (1, 2, None), (1, 3, "I"), (2, 1, None)], "d int, p int, h string")
    assert rows(df.withColumn("c", windows.carried(F.col("h"), ["d"], [F.col("p")])), "d", "p", "c") == [(1, 1, "H"), (1, 2, "H"), (1, 3, "I"), (2, 1, None)]
    x = spark.createDataFrame([(["a", "b", "STOP", "c"],), ([],)], "v array<string>")
    assert [r.k for r in x.select(windows.until(F.col("v"), lambda y: y == "STOP").alias("k")).collect()] == [["a", "b"], []]
    h = spark.createDataFrame([(1, 2020, 5), (1, 2022, None), (1, 2021, 7)], "k int, y int, v int")
    r = windows.history(h, "k", "y", "v").first()
    assert r.current == 7 and [x.year for x in r.history] == [2022, 2021, 2020]


def test_document_layouts(spark):
    lines = [(1, 0, "SECTION A"), (1, 1, "title one"), (1, 2, "* Ann"), (1, 3, "Univ X"), (1, 4, "* Bob"), (1, 5, "SECTION B"), (1, 6, "* Cy")]
    df = spark.createDataFrame(lines, "doc int, pos int, text string")
    got = documents.parse("anchored", df, anchor=F.startswith("text", F.lit("*")), header=F.startswith("text", F.lit("SECTION"))).orderBy("pos").collect()
    assert [(r.section, r.name, r.affiliation, r.title) for r in got] == [("SECTION A", "* Ann", "Univ X", "title one"), ("SECTION A", "* Bob", "", "Univ X"), ("SECTION B", "* Cy", "", "")]
    cells = spark.createDataFrame([(1, 0, ["Ann", "X"]), (1, 1, ["t1", "1,000円"]), (1, 2, ["Bob", "Y"]), (1, 3, ["Cy", "Z"])], "doc int, pos int, cells array<string>")
    got = documents.parse("paired", cells, is_first=F.get("cells", F.lit(0)) != "t1").orderBy("pos").collect()
    assert [(r.name, r.title, r.amount) for r in got] == [("Ann", "t1", 1000), ("Bob", None, None), ("Cy", None, None)]
    cells = spark.createDataFrame([(1, 0, ["Ann", "X", "50"]), (1, 1, ["more"]), (1, 2, ["Bob", "Y", "t", "1,00"])], "doc int, pos int, cells array<string>")
    got = documents.parse("trailing_amount", cells).orderBy("pos").collect()
    assert [(r.name, r.title, r.amount) for r in got] == [("Ann", "more", 500_000), ("Bob", "t", 1_000_000)]
    text = spark.createDataFrame([(1, 0, "事業費 1,000,000 2,000,000"), (1, 1, "助成金支出 3,000,000"), (2, 0, "本文 9,000,000")], "doc int, pos int, text string")
    assert [tuple(r) for r in documents.parse("statement", text, keywords=["助成金支出", "事業費"]).collect()] == [(1, "助成金支出", 3_000_000)]
    tags = spark.createDataFrame([(1, 0, "n", "Ann"), (1, 0, "a", "5円")], "doc int, pos int, class string, text string")
    r = documents.parse("tagged", tags, classes={"name": "n", "amount": "a"}).first()
    assert (r.name, r.amount) == ("Ann", 5)


def test_links_and_candidates(spark, rows):
    h = spark.createDataFrame([(1, '<a href="http://x.com/1">a</a><table class="infobox"><a href="http://y.com">b</a></table><a href="http://own.org/z">c</a>')], "id int, h string")
    assert [r.url for r in documents.external_links(h, "id", "h", "own.org").orderBy("place").collect()] == ["http://y.com", "http://x.com/1"]
    o = spark.createDataFrame([(1, "a.org")], "id int, host string")
    assert rows(documents.disclosure_candidates(o, ["http://{host}/{yyyy}", "http://{host}/r{r}"], [2023]), "url") == [("http://a.org/2023",), ("http://a.org/r5",)]


def test_readers(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('[{"name": "x", "n": 1}, {"name": "y"}]')
    assert rows(readers.json_records(spark, str(tmp_path / "a.json"), "name string, n int")) == [("x", 1), ("y", None)]
    (tmp_path / "k.json").write_text('{"org1": {"v": 1}, "org2": {"v": null}}')
    assert rows(readers.keyed_json(spark, str(tmp_path / "k.json"), "struct<v:int>").select("key", "value.v")) == [("org1", 1), ("org2", None)]
    (tmp_path / "t.txt").write_bytes("円".encode("cp932"))
    assert rows(readers.decoded(spark, str(tmp_path / "t.txt")), "encoding", "text") == [("cp932", "円")]
    (tmp_path / "team1.txt").write_text("hello\nworld")
    assert rows(readers.text_files(spark, str(tmp_path / "team*.txt"))) == [("team1.txt", "hello\nworld")]
    h = spark.createDataFrame([(1, '<table><tr><th>名</th><td>A</td></tr><tr><th>URL</th><td><a href="http://a">x</a></td></tr></table>')], "id int, h string")
    assert rows(readers.html_rows(h, "id", "h"), "label", "value", "href") == [("URL", "x", "http://a"), ("名", "A", None)]
    ls = spark.createDataFrame([(1, i, t) for i, t in enumerate(["junk", "# One", "目的: p", "住所: q", "# Two", "目的: r"])], "d int, p int, t string")
    got = rows(readers.entries(ls, "d", "p", "t", F.startswith("t", F.lit("#")), {"purpose": "目的", "address": "住所"}), "name", "purpose", "address")
    assert got == [("# One", "p", "q"), ("# Two", "r", None)]
    a = spark.createDataFrame([("A ", [1, 2])], "k string, xs array<int>")
    b = spark.createDataFrame([("a", [2, 3]), ("", [9])], "k string, xs array<int>")
    assert rows(readers.merged_records([a, b], F.lower(F.trim("k")), "xs")) == [("a", [1, 2, 3])]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b|x", 2), ("a", 4)], "k string, n int")
    writers.ranked_csv(df, str(tmp_path / "c"), [F.desc("n")])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).orderBy("rank").first().k == "a"
    writers.json_report(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert writers.snapshot(df, str(tmp_path / "s"), "one").count() == 2
    assert "b\\|x" in writers.markdown(df, "T") and "<th>k</th>" in writers.html(df, "T")
    assert [r.bar for r in writers.bars(df, "n", 4).orderBy("n").collect()] == ["##", "####"]


def test_checks(spark):
    df = spark.createDataFrame([(1, ""), (2, "x"), (None, "x")], "id int, t string")
    rep = checks.report(checks.rows("s", df, {"blank": (F.col("t") == "", 1, 2), "none": (F.col("id") < 0, 1, None)}), checks.null_rates("s", df, ["id", "t"]))
    assert {(r.check, r.status) for r in rep.collect()} == {("blank", "WARN"), ("none", "PASS"), ("id", "WARN"), ("t", "WARN")}
    assert checks.exit_code(rep) == 0


def test_schema_evolution(spark):
    df = spark.createDataFrame([("1", "x", 5)], "id string, extra string, level string")
    out = schemas.ensure_columns(df, "foundation_categories")
    assert out.columns[:3] == ["id", "parent_id", "level"] and out.columns[-1] == "extra"
    assert dict(out.dtypes)["level"] == "int"


def test_views_over_the_star(spark, rows):
    o = schemas.ensure_columns(spark.createDataFrame([("o1", "A", None), ("o2", "B", "o1"), ("o3", "C", None)], "id string, name string, duplicate_of string"), "organizations")
    p = schemas.ensure_columns(spark.createDataFrame([("p1", "o1", "P", "research"), ("p2", "o2", "Q", "award")], "id string, organization_id string, name string, category string"), "grant_programs")
    c = schemas.ensure_columns(spark.createDataFrame([("c1", "p1", "T", 100), ("c2", "p1", "U", 50)], "id string, program_id string, title string, grant_amount_max long"), "grant_calls")
    r = schemas.ensure_columns(spark.createDataFrame([("r1", "c1", "Ann")], "id string, call_id string, awardee_name string"), "grant_results")
    assert rows(views.foundation_summary(o, p, c), "id", "programs", "calls", "most") == [("o1", 1, 2, 100), ("o2", 1, 0, None), ("o3", 0, 0, None)]
    assert rows(views.fact_awards(r, c, p, o), "awardee_name", "organization_id", "program_name") == [("Ann", "o1", "P")]
    m = spark.createDataFrame([("x", "o1")], "cfg_id string, grant_db_id string")
    assert rows(views.grant_calls_for("x", m, c, p), "id") == [("c1",), ("c2",)]
    assert views.grants_overview(o, p, c).count() == 2


def test_stream_replaces_slices_once(spark, tmp_path, rows):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "parent string, source string, v int"
    spark.createDataFrame([("a", "s", 1), ("b", "s", 2)], schema).coalesce(1).write.parquet(src)
    for _ in range(2):
        ingest.replace_batches(spark, src, schema, out, ["parent"], cp).awaitTermination()
    spark.createDataFrame([("a", "s", 9)], schema).coalesce(1).write.mode("append").parquet(src)
    ingest.replace_batches(spark, src, schema, out, ["parent"], cp).awaitTermination()
    assert rows(spark.read.parquet(out), "parent", "v") == [("a", 9), ("b", 2)]


def test_streaming_windows(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.createDataFrame([("2024-01-01 00:05:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "a", 3.0)], "ts string, k string, value double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, k string, value double").parquet(src)
    q = ingest.windowed_counts(stream, "ts", ["k"], "1 hour").writeStream.outputMode("complete").format("memory").queryName("w_out").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n for r in spark.sql("SELECT * FROM w_out").collect()) == [1, 2]


@pytest.mark.parametrize("empty", ["hhi", "upsert", "tiered"])
def test_empty_inputs(spark, empty):
    if empty == "hhi":
        assert A.hhi(spark.createDataFrame([], "n long"), by=[]).first().members == 0
    elif empty == "upsert":
        e = spark.createDataFrame([], "id int, x string")
        assert merging.upsert(e, e, ["id"], ["x"])[0].count() == 0
    else:
        left, right = spark.createDataFrame([], "lid int, name string, host string"), spark.createDataFrame([], "rid int, name string, host string")
        assert matching.tiered(left, right).count() == 0
