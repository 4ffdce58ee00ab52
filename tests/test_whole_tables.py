"""The matching and merging queries on whole tables: no row is left out by its id."""

from conftest import SF

from fundscope.catalog import QUERIES
from fundscope.operators import matching


def test_late_rows_take_part(spark):
    get = lambda name: QUERIES[name](spark, SF)
    table = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    assert get("match_tier").filter("lid > 400").count() > 0
    assert {r.method for r in get("job_integration").collect()} == {"name", "host", "contains"}
    assert get("match_fuzzy").count() == table("supplier").count()
    assert get("insert_missing_types").count() == 2 * table("orders").count()


def test_fuzzy_against_all_pairs(spark, rows):
    names = ["acme", "acme trust", "trust", "fund", "funds of acme", "acm", "trusted", "", "other fund", "acme"]
    x, t = names[:6] + ["trustee x"], names

    def kind(a, b):
        if a == b:
            return "equal"
        if (len(a) >= 4 and a in b) or (len(b) >= 4 and b in a):
            return "contains"
        return "prefix" if len(a) >= 5 and a[:5] in b else None

    want = []
    for i, a in enumerate(x):
        hits = [(j, kind(a, b)) for j, b in enumerate(t) if kind(a, b)]
        want += [(i, *hits[0])] if hits else []
    frame = lambda values, key: spark.createDataFrame(list(enumerate(values)), f"{key} long, name string")
    assert rows(matching.fuzzy_first(frame(x, "xid"), frame(t, "tid"))) == sorted(want, key=repr)


def test_tiebreak_compares_whole_texts(spark, tmp_path, rows):
    head = "the same first twenty-four characters, "
    spark.createDataFrame([(1, head + "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, head + "a"), (2, head + "b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert rows(QUERIES["composite_key_tiebreak"](spark, str(tmp_path))) == [(1, 2)]
