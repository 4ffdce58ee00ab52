"""Matching in large groups: results as of comparing all pairs, from joins whose rows grow with the tables."""

import random

from pyspark.sql import functions as F

from fundscope.catalog import QUERIES
from fundscope.operators import matching


def most_joined(df):
    """Rows of the join that gave the most while the frame was collected."""
    df.collect()
    todo, most, joins = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            if "Join" in kind and p.metrics().contains("numOutputRows"):
                joins, most = joins + 1, max(most, p.metrics().apply("numOutputRows").value())
            children = p.children()
            todo += [children.apply(k) for k in range(children.size())]
    assert joins
    return most


def suppliers(spark, folder, n):
    spark.range(n).selectExpr("id AS s_suppkey", "concat('Supplier#', lpad(id, 9, '0')) AS s_name", "CAST(id % 25 AS INT) AS s_nationkey", "1.0D AS s_acctbal").write.parquet(f"{folder}/supplier.parquet")


def shuffled(spark, job):
    """Rows that the stages of a job wrote for shuffles, and its result."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm

    def written():
        sc.listenerBus().waitUntilEmpty(30_000)
        stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (stages.apply(k) for k in range(stages.size()))}

    before, result = written(), job()
    return sum(n for stage, n in written().items() if stage not in before), result


def test_fuzzy_makes_no_pairs_of_names_that_share_a_beginning(spark, tmp_path):
    suppliers(spark, tmp_path, 600)
    df = QUERIES["match_fuzzy"](spark, str(tmp_path))
    assert most_joined(df) < 600 * 20  # 360,000 pairs before
    assert df.count() == 600


def test_fuzzy_against_all_pairs_of_random_names(spark, rows):
    dice = random.Random(5)
    name = lambda: "".join(dice.choice("ab") for _ in range(dice.randint(0, 9)))
    x = [(dice.randint(0, 90), dice.choice([name(), name(), name(), None])) for _ in range(120)]
    t = [(None if k == 7 else k % 60, dice.choice([name(), name(), name(), None])) for k in range(90)]
    want = {}
    for xid, a in x:
        for tid, b in t:
            if a is None or b is None:
                continue
            k = 1 if a == b else 2 if (len(a) >= 4 and a in b) or (len(b) >= 4 and b in a) else 3 if len(a) >= 5 and a[:5] in b else None
            if k:
                want[xid] = min(want.get(xid, (True, 99, 9)), (tid is None, tid or 0, k))
    kinds = {1: "equal", 2: "contains", 3: "prefix"}
    got = rows(matching.fuzzy_first(spark.createDataFrame(x, "xid long, name string"), spark.createDataFrame(t, "tid long, name string")))
    assert got == sorted(((xid, None if none else tid, kinds[k]) for xid, (none, tid, k) in want.items()), key=repr)


def large_groups(spark, folder):
    """40,000 customers and 2,000 suppliers: 60 to 97 names, 25 nations."""
    suppliers(spark, folder, 2000)
    spark.range(40_000).selectExpr("id AS c_custkey", "CAST(id DIV 7 % 25 AS INT) AS c_nationkey").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def of_one(found):
    """The only element, or None."""
    return found[0] if len(found) == 1 else None


def test_linkage_bias_makes_no_pairs_of_rows_that_share_a_name(spark, tmp_path):
    assert most_joined(QUERIES["job_linkage_bias"](spark, large_groups(spark, tmp_path))) < 100_000  # 824,828 pairs before


def test_homonyms_against_all_pairs(spark, rows):
    dice = random.Random(7)
    insts = [None, "", "univ a", "the univ a", "univ b", "lab", "a lab of univ b", "ab"]
    people = [(k % 150, dice.choice("abcdefghijkl") if k % 9 else None, dice.choice(insts)) for k in range(170)]
    index = [(k, dice.choice("abcdefghijkm" * 4 + "kl"), dice.choice(insts)) for k in range(30)] + [(3, "a", "lab"), (50, "l", None), (51, None, "lab")]
    for parity in (False, True):
        want = []
        for pid in range(150):
            near = [(x, i or "", j or "") for p, n, i in people if p == pid for x, m, j in index if n is not None and n == m]
            ok = [x for x, i, j in near if (i[:4] in j or j[:4] in i) and (parity or (i and j))]
            if len(near) == 1:
                want.append((pid, near[0][0], "unique"))
            elif of_one(ok) is not None:
                want.append((pid, ok[0], "institution"))
        assert len(want) > 20
        got = matching.homonyms(spark.createDataFrame(people, "pid long, name string, inst string"), spark.createDataFrame(index, "xid long, name string, inst string"), prefix=4, parity=parity)
        assert rows(got) == sorted(want, key=repr)


def test_homonyms_make_no_pairs_of_rows_that_share_a_name(spark, tmp_path):
    assert most_joined(QUERIES["match_homonym"](spark, large_groups(spark, tmp_path))) < 100_000  # 824,828 pairs before


def test_homonyms_shuffle_no_row_that_cannot_matter(spark, rows, tmp_path):
    suppliers(spark, tmp_path, 20_000)
    spark.range(40_000).selectExpr("id AS c_custkey", "CAST(id DIV 7 % 25 AS INT) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    n, got = shuffled(spark, lambda: rows(QUERIES["match_homonym"](spark, str(tmp_path))))
    assert got == []
    assert n < 20_000  # 55,304 before


def test_homonyms_of_ids_with_several_rows(spark, rows):
    index = spark.createDataFrame([(1, "a", "univ x"), (2, "b", "univ x"), (3, "b", "univ y"), (4, "b", None)], "xid long, name string, inst string")
    people = [(1, "a", None), (1, "b", None), (2, "b", "univ y"), (2, "b", None), (3, "b", "univ y"), (3, "b", "univ x"), (None, "a", None), (4, "a", None), (4, "z", None), (5, "b", None), (6, None, "univ x")]
    one = spark.createDataFrame(people, "pid long, name string, inst string")
    want = [(2, 3, "institution"), (4, 1, "unique"), (None, 1, "unique")]
    assert rows(matching.homonyms(one, index)) == sorted(want, key=repr)
    two = one.unionByName(spark.createDataFrame([(None, "b", None), (4, "b", None)], one.schema))  # no row alone says that these are unique no more
    assert rows(matching.homonyms(two, index)) == want[:1]
    for few in (0, 5, 6, 20_000):  # 6 rows meet the condition: from there on their ids are sent to all rows
        c = matching.candidates(two, index.withColumnRenamed("inst", "xinst"), "name", "pid", "xid", [F.col("inst") == F.col("xinst")], "n0 = 1 or n1 = 1", few)
        assert rows(c.filter("n0 = 1 or n1 = 1"), "pid", "x1") == [(2, 3)]


def test_conservative_makes_no_pairs_of_rows_that_share_a_name(spark, tmp_path):
    assert most_joined(QUERIES["match_conservative"](spark, large_groups(spark, tmp_path))) < 100_000  # 1,000,000 pairs before


def test_conservative_against_all_pairs(spark, rows):
    dice = random.Random(8)
    tokens = lambda: dice.choice([None, [], *[[dice.choice("pqrst") for _ in range(dice.randint(1, 2))] for _ in range(4)]])
    people = [(k % 150, dice.choice("abcdefghijkl"), tokens()) for k in range(170)]
    index = [(k, dice.choice("abcdefghijkm" * 4 + "kl"), tokens(), dice.choice([1, 1, 2, None])) for k in range(30)] + [(50, "l", None, 1), (3, "b", ["p"], 1)]
    want = []
    for pid in range(150):
        near = [(x, set(a or ()) & set(b or ()), h) for p, n, a in people if p == pid for x, m, b, h in index if n == m]
        shared = [x for x, both, _ in near if both]
        if len(near) == 1 and near[0][2] == 1:
            want.append((pid, near[0][0], "unique_name"))
        elif of_one(shared) is not None:
            want.append((pid, shared[0], "institution_token"))
    assert len(want) > 20
    got = matching.conservative(spark.createDataFrame(people, "pid long, name string, tokens array<string>"), spark.createDataFrame(index, "xid long, name string, tokens array<string>, homonyms long"))
    assert rows(got) == sorted(want, key=repr)


def test_disambiguated_makes_no_pairs_of_rows_that_share_a_key(spark, tmp_path):
    assert most_joined(QUERIES["match_disambiguated"](spark, large_groups(spark, tmp_path))) < 100_000  # 1,142,870 pairs before


def test_disambiguated_against_all_pairs(spark, rows):
    dice = random.Random(9)
    entities = [(k % 150 if k else None, dice.choice("abcdefghijklz"), dice.choice([None, *range(12)])) for k in range(170)]
    registry = [(k, dice.choice("abcdefghijkm" * 4 + "kl"), dice.choice([None, *range(12)])) for k in range(30)] + [(50, "l", None), (3, "b", 2)]
    want = []
    for eid in {e for e, _, _ in entities}:
        near = [(r, a, b) for e, n, a in entities if e == eid and eid is not None for r, m, b in registry if n == m]
        exact = [r for r, a, b in near if None not in (a, b) and a == b]
        loose = [r for r, a, b in near if None not in (a, b) and a % 5 == b % 5]
        found = [(f[0], rule) for f, rule in (([r for r, _, _ in near], "single"), (exact, "exact"), (loose, "loose")) if len(f) == 1]
        want.append((eid, *(found or [(None, "unresolved" if near else "none")])[0]))
    assert len({rule for _, _, rule in want}) == 5
    tests = [("exact", F.col("a") == F.col("b")), ("loose", F.col("a") % 5 == F.col("b") % 5)]
    got = matching.disambiguated(spark.createDataFrame(entities, "eid long, key string, a long"), spark.createDataFrame(registry, "rid long, key string, b long"), tests)
    assert rows(got) == sorted(want, key=repr)


def test_null_safe_join_counts_matches(spark, tmp_path):
    df = QUERIES["null_safe_join"](spark, large_groups(spark, tmp_path))
    assert most_joined(df.agg({"c_custkey": "count"})) <= 40_000  # 3,200,000 rows before
    assert df.count() == 40_000 * 2000 // 25


def test_rows_repeated_per_match(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (None, "a"), (1, "a"), (4, "c")], "id long, key string")
    right = spark.createDataFrame([("a",)] * 5 + [(None,)] * 3 + [("c",), ("d",)], "key string")
    want = rows(left.join(right.toDF("k"), F.col("key").eqNullSafe(F.col("k"))).select("id", "key"))
    assert len(want) == 19
    for piece in (1, 2, 5, 1024):
        assert rows(matching.repeated_per_match(left, right, "key", piece)) == want
