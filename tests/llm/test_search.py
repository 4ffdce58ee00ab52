import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from fundscope.llm import ann
from fundscope.llm import ngram_join as N
from fundscope.llm.components import components, forest


def test_nearest_recall_against_brute_force(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = ann.nearest(e, F.col("vec_id") % 20 == 0, leaf_rows=16).toPandas()
    x = e.toPandas()
    ids, v = x.vec_id.values, np.array(x.embedding.tolist(), float)
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = v @ v[ids == q][0]
        s[ids == q] = -9
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.allclose(mine.score.values, [s[ids == i][0] for i in mine.vec_id], atol=1e-12)
        hits += len(set(mine.vec_id) & set(ids[np.lexsort((ids, -s))[:20]]))
    assert hits / (20 * (ids % 20 == 0).sum()) >= 0.9


def test_nearest_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (20, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 9) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 2, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 0.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_many_equal_vectors_keep_the_smallest_ids(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(300)] + [(1000, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = sorted((r.rank, r.vec_id) for r in ann.nearest(df, F.col("vec_id") == 40).collect())
    assert got == [(k + 1, k) for k in range(20)]


def brute(texts):
    sets = [set(N.shingles(w).tolist()) for w in N.Words(pa.array(texts, pa.string())).rows()]
    return [[j for j in range(len(sets)) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(sets))]


def test_join_equals_brute_force_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(600)
    rows = docs.collect()
    want = {rows[i].doc_id: len(x) for i, x in enumerate(brute([r.text for r in rows]))}
    got = {r.doc_id: r.n_links for r in N.near_duplicates(docs).collect()}
    assert got == want


@pytest.fixture(scope="module")
def group():
    """Near copies of one long text, each with words of its own in two places."""
    base = [f"w{k}" for k in range(200)]
    out = []
    for i in range(150):
        w = list(base)
        w[i % 50 + 10] = f"x{i}"
        out.append(" ".join(w))
    return out


def test_large_group_in_blocks_and_deep_paths(spark, group):
    docs = spark.createDataFrame(list(enumerate(group)), "doc_id long, text string")
    want = {i: len(x) for i, x in enumerate(brute(group))}
    got = N.near_duplicates(docs, small=16, block_members=20).collect()
    assert {r.doc_id: r.n_links for r in got} == want
    assert {r.class_id for r in got} == {0}


def test_join_edges(spark, rows):
    text = "one two three four five six seven eight"
    data = [(5, text), (3, text.upper() + "!"), (9, text), (9, text), (1, None), (2, ""), (4, "!!"), (6, "one two"), (7, "two one"), (None, text), (8, "one  two")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in data], "doc_id long, text string, rid int")
    got = rows(N.near_duplicates(docs))
    assert got == sorted([(5, 3, 4), (3, 3, 4), (9, 3, 4), (9, 3, 4), (None, 3, 4), (1, 1, 0), (2, 2, 0), (4, 4, 0), (6, 6, 1), (8, 6, 1), (7, 7, 0)], key=repr)
    assert N.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 30)] + [(50, 50)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(4)
    got = dict(components(df).collect())
    assert got == dict(components(df, alone=0).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 1 for k in range(1, 30)}}
    assert dict((b, a) for a, b in forest(np.array([3, 5, 9]), np.array([4, 4, 8]))) == {4: 3, 5: 3, 9: 8}


def test_meeting_probability_falls_with_depth():
    p = [N.meeting(d) for d in range(6)]
    assert p[0] == 1 and all(a > b for a, b in zip(p, p[1:], strict=False))


def test_hot_members_reach_all_their_copies(spark, rows):
    docs = spark.createDataFrame([(i, "a b c d e f g" if i % 3 else f"text number {i} stands alone here") for i in range(60)] + [(100, None)], "doc_id long, text string")
    sets = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None), (5, 7)], "doc_id long, rid long")
    known = spark.createDataFrame([(7, 3, 1, 2), (8, 1, 3, 0)], "rid long, copies long, class_id long, n_links long")
    want = [(1, 1, 2), (2, 1, 2), (3, 3, 0), (4, 4, 0), (5, 1, 2)]
    assert rows(N._spread(sets, known)) == rows(N._spread(sets, known, least=2)) == want
    got = {r.doc_id: (r.class_id, r.n_links) for r in N.near_duplicates(docs).collect()}
    assert got[1] == (1, 39) and got[59] == (1, 39) and got[100] == (100, 0)


def test_small_leaves_do_not_cut_the_neighbours():
    # two calibrated visits end in leaves of few points; the queue goes on until they hold k others
    tree = ann.Tree(np.eye(5), [[1, 2, 3, 4], [], [], [], []], [-1, 0, 1, 2, 3])
    sizes = {0: 3, 1: 2, 2: 40}
    q = np.array([0.0, 4, 3, 2, 1])
    assert len(tree.visits(q, 2)) == 2
    assert sum(sizes.get(leaf, 0) for leaf in ann._enough(tree, q, 2, sizes, 20)) > 20
    assert len(ann._enough(tree, q, 2, sizes, 4)) == 2
    assert len(ann._enough(tree, q, 2, sizes, 100)) == 4


def _at(similarity, words, rng, k):
    """Two texts whose shingle sets have just the similarity, or the next one above."""
    a = [f"p{k}w{j}" for j in range(words)]
    b, changed = list(a), 0
    total = words - N.SHINGLE + 1
    while True:
        c = list(b)
        c[N.SHINGLE * (2 * changed + 1)] = f"q{k}x{changed}"
        broken = N.SHINGLE * (changed + 1)
        if (total - broken) / (total + broken) < similarity:
            return " ".join(a), " ".join(b)
        b, changed = c, changed + 1


def test_recall_at_just_the_similarity(spark):
    """Pairs at 0.80 to 0.82, with clean texts around them: the calibrated recall, for small and for large nodes."""
    rng, texts = np.random.default_rng(6), []
    for k in range(300):
        texts += _at(0.8, 230 + int(rng.integers(0, 40)), rng, k)
    pairs = [len(x & y) / len(x | y) for x, y in zip(*(map(set, map(np.ndarray.tolist, map(N.shingles, N.Words(pa.array(texts[i::2])).rows()))) for i in (0, 1)), strict=True)]
    assert min(pairs) >= 0.8 and np.mean(pairs) < 0.82
    docs = spark.createDataFrame(list(enumerate(texts)) + [(10_000 + k, " ".join(f"c{k}y{j}" for j in range(50))) for k in range(300)], "doc_id long, text string")
    for options in ({}, {"small": 2}):
        got = {r.doc_id: (r.class_id, r.n_links) for r in N.near_duplicates(docs, **options).collect()}
        found = sum(got[2 * k] == got[2 * k + 1] == (2 * k, 1) for k in range(300))
        assert found >= 0.97 * 300
        assert all(got[10_000 + k] == (10_000 + k, 0) for k in range(300))


def test_very_long_texts_join_whole(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, long.replace("w5", "v5")), (4, "short text of some five words")], "doc_id long, text string")
    want = {i + 1: len(x) for i, x in enumerate(brute([r.text for r in docs.orderBy("doc_id").collect()]))}
    assert {r.doc_id: r.n_links for r in N.near_duplicates(docs, block_shingles=50_000).collect()} == want


def test_components_with_a_hub_and_odd_rows(spark):
    edges = [(0, k) for k in range(1, 3000)] + [(k, k + 10_000) for k in range(1, 3000)] + [(7, 7), (0, 1), (0, 1)]
    df = spark.createDataFrame([(a, b, 1) for a, b in edges], "u long, v long, m int").repartition(6)
    got = dict(components(df, alone=0).collect())
    assert len(got) == 5999 and set(got.values()) == {0} and got == dict(components(df).collect())
    assert components(df.limit(0)).count() == 0


def test_stars_connect_a_large_node(spark):
    big = spark.createDataFrame([(n, r, 500) for n in (-3, 8) for r in range(500 * (n == 8) - 250, 500 * (n == 8) + 250)], "node long, rid long, members long")
    got = dict(components(N._starred(big, 20)).collect())
    assert len(got) == 1000 and set(got.values()) == {-250, 250}


def test_an_id_with_several_vectors_counts_once(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.5, 9.0]), (1, [1.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 2, 27.0), (0, 2, 1, 9.5)]
