from fundscope.llm import preference as P


def test_prefix_is_rendered_once_and_masks_cover_assistants(spark):
    t = [("chosen", 0, "user", "hi"), ("chosen", 1, "assistant", "yo"), ("chosen", 2, "user", "ok"), ("rejected", 0, "user", "hi"), ("rejected", 1, "assistant", "no")]
    df = spark.createDataFrame([(1, *x, "junk") for x in t], "pair_id long, side string, turn long, role string, text string, place string")
    r = P.preference_rows(df).first()
    assert r.prompt == "<|user|>\nhi<|end|>\n" and r.prompt_turns == 1
    assert r.chosen == "<|assistant|>\nyo<|end|>\n<|user|>\nok<|end|>\n"
    assert [r.chosen[s.begin : s.end] for s in r.chosen_spans] == ["yo<|end|>\n"]
    assert [r.rejected[s.begin : s.end] for s in r.rejected_spans] == ["no<|end|>\n"]


def test_equal_sides_nulls_and_missing_sides(spark):
    rows = [(1, "chosen", 0, "user", None), (1, "rejected", 0, "user", None), (2, "chosen", 0, None, "a"), (3, "rejected", 5, "user", "b"), (None, "chosen", 0, "user", "x"), (4, "chosen", None, "user", "x"), (5, "other", 1, "user", "x")]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    got = {r.pair_id: (r.prompt, r.chosen, r.rejected) for r in P.preference_rows(df).collect()}
    assert got == {1: ("<|user|>\n<|end|>\n", "", ""), 2: ("", "<||>\na<|end|>\n", ""), 3: ("", "", "<|user|>\nb<|end|>\n")}


def test_repeated_rows_are_turns_and_empty_input_gives_nothing(spark):
    df = spark.createDataFrame([(1, "chosen", 0, "user", "a")] * 2 + [(1, "rejected", 0, "user", "a")], "pair_id long, side string, turn long, role string, text string")
    r = P.preference_rows(df).first()
    assert (r.prompt_turns, r.chosen, r.rejected) == (1, "<|user|>\na<|end|>\n", "")
    assert P.preference_rows(df.limit(0)).count() == 0


def test_swapped_answers(spark):
    c = spark.createDataFrame([(0, 0, "user", "q"), (0, 1, "assistant", "good"), (1, 0, "assistant", "else"), (7, 0, "user", "alone"), (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {r.pair_id: (r.prompt_turns, r.chosen[-14:], r.rejected) for r in P.preference_rows(P.swapped_answers(c)).collect()}
    assert got[0][0] == 1 and got[0][2] == "<|assistant|>\nelse<|end|>\n"
    assert got[7][0] == 0 and got[7][2] == ""


def test_ties_nulls_and_repeats_as_in_sql(spark, tmp_path):
    import random

    import duckdb

    from fundscope.llm import queries as Q

    rnd = random.Random(5)
    pick = lambda *x: rnd.choice(x)
    rows = [(pick(None, -2, -1, 0, 1, 2, 3, 8), pick(None, 0, 1, 1, 2), pick(None, "user", "assistant"), pick(None, "", "a", "b")) for _ in range(400)]
    rows += [(20 + k, t, pick("user", "assistant"), pick("x", "y", None)) for k in range(40) for t in range(rnd.randrange(1, 4)) for _ in range(pick(1, 1, 1, 2))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    df = Q.op2_preference_format(spark, str(tmp_path))
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({Q.ORACLES['op2_preference_format']})").fetchall()
    got = sorted(map(tuple, df.select(columns).collect()), key=repr)
    assert got == sorted(want, key=repr) and len(got) > 40


def test_a_long_conversation_comes_whole_in_one_exchange(spark):
    turns = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k} " + "x" * 200) for k in range(20_000)] + [(0, 0, "user", "other")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    pairs = P.swapped_answers(df)
    out = P.preference_rows(pairs)
    assert sum("Exchange" in x for x in out._jdf.queryExecution().executedPlan().toString().split("\n")) <= 2
    r = out.filter("pair_id = 1").first()
    assert r.prompt_turns == 19_999 and r.rejected.endswith("other<|end|>\n") and r.chosen.startswith("<|assistant|>\nturn 19999 ")
