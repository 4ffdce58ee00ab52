"""Iterative operators against plain scans."""

import random

import pytest
from pyspark.sql import functions as F

from fundscope.functions import names as N
from fundscope.operators import aggregates, matching, merging, patterns


def scan(edges):
    taken, out = set(), []
    for left in sorted({a for a, _ in edges}):
        free = sorted(b for a, b in edges if a == left and b not in taken)
        if free:
            taken.add(free[0])
            out.append((left, free[0]))
    return out


def test_greedy_equals_the_scan_with_chains_of_rivals(spark, rows):
    rng = random.Random(3)
    chain = [(k, k) for k in range(12)] + [(k, k - 1) for k in range(1, 12)] + [(k, 0) for k in range(12)]
    for edges in (chain, [(rng.randrange(30), rng.randrange(25)) for _ in range(150)], [(1, 1), (2, 1), (2, 2), (2, 2)]):
        got, rounds = matching.greedy(spark.createDataFrame(edges, "l long, r long"), "l", "r")
        assert rows(got, "l", "r") == sorted(scan(edges), key=repr) and rounds >= 1
    assert matching.greedy(spark.createDataFrame([(None, 1), (2, None)], "l long, r long"), "l", "r")[0].count() == 0


def test_losers_of_a_loose_match_go_on(spark, rows):
    s = spark.createDataFrame([(1, "abcd"), (2, "abcd"), (3, "abcd")], "sid long, key string")
    t = spark.createDataFrame([(1, "xxabcd"), (2, "yyabcd")], "tid long, key string")
    assert rows(matching.loose_fallback(s, t)) == [(1, 1, "contains"), (2, 2, "contains")]


def test_chains_of_merged_ids(spark, rows):
    chain = spark.createDataFrame([(f"k{i}", f"k{i + 1}") for i in range(37)] + [("a", "b"), ("a", "b"), ("x", "x"), (None, "y")], "old_id string, new_id string")
    got = dict(rows(merging.resolved(chain)))
    assert got["a"] == "b" and all(got[f"k{i}"] == "k37" for i in range(37)) and len(got) == 38
    kids = spark.createDataFrame([("a", 1), ("k0", 2), ("other", 3)], "p string, n int")
    assert rows(merging.repoint(kids, chain, "p")) == sorted([("b", 1), ("k37", 2), ("other", 3)], key=repr)
    for bad in ([("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b")], [("a", "b"), ("a", "c")]):
        with pytest.raises(ValueError):
            merging.resolved(spark.createDataFrame(bad, "old_id string, new_id string"))


def test_places_of_patterns_equal_a_scan(spark, rows):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("abé京") for _ in range(rng.randrange(0, 60)))) for i in range(40)] + [(99, None), (98, "")]
    pats = [(i, "".join(rng.choice("abé京") for _ in range(rng.randrange(1, 7)))) for i in range(30)] + [(50, None), (51, ""), (52, "zzzz")]
    want = sorted(((p, t, k + 1) for p, x in pats if x for t, y in texts if y for k in range(len(y)) if y.startswith(x, k)), key=repr)
    got = patterns.occurrences(spark.createDataFrame(pats, "pid long, pattern string"), spark.createDataFrame(texts, "tid long, text string"))
    assert rows(got) == want and len(want) > 100


def test_order_statistics_of_one_group_without_bringing_it_together(spark):
    rng = random.Random(7)
    values = [rng.gauss(0, 1) * 10 ** rng.randrange(-3, 9) for _ in range(4001)] + [5.0] * 3000
    rows_ = [("g", v) for v in values] + [("h", 1.0), (None, 2.0), (None, 4.0), ("n", None), ("g", float("nan"))]
    got = {r.k: (r.n, r.lower, r.upper) for r in aggregates.order_statistics(spark.createDataFrame(rows_, "k string, v double"), "k", "v", few=50, cells=16).collect()}
    s = sorted(values)
    assert got == {"g": (7001, s[3500], s[3500]), "h": (1, 1.0, 1.0), None: (2, 2.0, 4.0)}


def test_a_second_run_of_the_star_changes_nothing(spark, rows):
    r = [(1, "org", "p", 2020, " Ann ", "t", 5.0, None), (2, "org", "p", 2020, "Ann", "t", None, "u"), (3, "org", None, 2021, "", "t", 1.0, None), (4, "new", "p", None, "Bob", "t", 1.0, None), (5, None, "p", 2020, "Cy", "　t　", 2.0, None)]
    records = spark.createDataFrame(r, "seq long, organization string, program string, fiscal_year int, awardee string, title string, amount double, source_url string")
    empty = {
        "organisations": spark.createDataFrame([], "id string, name string"), "programs": spark.createDataFrame([], "id string, organization_id string, name string"),
        "calls": spark.createDataFrame([], "id string, program_id string, fiscal_year int"), "results": spark.createDataFrame([], "id string, call_id string, awardee string, title string, amount double, source_url string"),
    }
    one, plan = merging.upsert_star(empty, records)
    assert rows(plan) == [("calls", 3, 0, 0), ("organisations", 2, 0, 0), ("programs", 3, 0, 0), ("results", 2, 0, 0)]
    assert rows(one["results"], "awardee", "title", "amount", "source_url") == [("Ann", "t", 5.0, "u"), ("Cy", "t", 2.0, None)]
    two, plan = merging.upsert_star(one, records)
    assert rows(plan) == [("calls", 0, 3, 0), ("organisations", 0, 2, 0), ("programs", 0, 3, 0), ("results", 0, 2, 0)]
    assert all(rows(two[k].select(sorted(two[k].columns))) == rows(one[k].select(sorted(one[k].columns))) for k in one)


@pytest.mark.parametrize("blank", ["　", " ", "\t", "\xa0"])
def test_names_with_any_blank(spark, blank):
    b = blank
    want = {
        f"{b}公益財団法人山田": "山田", f"公益財団法人{b}株式会社山田": "山田", f"公益財団法人山田（東京）{b}": "山田", f"{b}株式会社{b}山田{b}(x){b}": "山田",
    }
    df = spark.createDataFrame([(k,) for k in want], "name string")
    for p in ("xdb", "dedup") + ("inventory",) * (b in "　 "):
        got = {r.name: r.key for r in df.withColumn("key", N.normalize_name(F.col("name"), p)).collect()}
        assert got == want, p
    search = {r.name: r.key for r in df.withColumn("key", N.normalize_name(F.col("name"), "search")).collect()}
    assert list(search.values()) == ["山田", "株式会社山田", "山田", "山田"]


def test_pages_refuse_what_they_would_leave_out(spark):
    from fundscope.sources import writers

    assert writers.markdown(spark.range(5), "T", most=5).count("\n") == 9
    for write in (writers.markdown, writers.html):
        with pytest.raises(ValueError):
            write(spark.range(6), "T", most=5)
