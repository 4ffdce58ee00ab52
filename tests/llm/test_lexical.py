import math
import re
from collections import Counter

import numpy as np
from conftest import SF

from fundscope.llm import lexical as L


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=20):
    """All scores in plain integers; (item, rank, doc, score)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    merged = {}
    for item, text in items:
        merged.setdefault(item, Counter()).update(terms(text))
    for item, asked in merged.items():
        scores = []
        for place, (i, c) in enumerate(counts):
            m = 100 - 25 + (25 * sum(c.values()) * total) // length
            s = sum(q * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, place, i))
        out += [(item, r, x[4], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in L.search(d, i, **options).collect()), key=repr)


def prose(seed, n, words=40, vocabulary=300):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, vocabulary + 1)
    return [(k, " ".join(f"t{x}" for x in rng.choice(vocabulary, int(rng.integers(1, words)), p=share / share.sum()))) for k in range(n)]


def test_small_shards_and_blocks_of_items_equal_brute_force(spark):
    docs, items = prose(1, 400), prose(2, 30, 25)
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, postings=500, few=25) == want
    assert run(spark, docs, items, block_terms=100) == want


def test_ties_repeats_nulls_and_case(spark):
    docs = [(k, "same words here") for k in range(60, 0, -1)] + [(100, None), (101, ""), (102, "?! ..."), (None, "same words here"), (7, "same words here"), (200, "SAME ÉTÉ été"), (201, "x " * 100_000 + "same")]
    items = [(1, "Same same WORDS"), (2, None), (3, "--"), (4, "absent"), (5, "ÉTÉ"), (6, "été"), (None, "words"), (7, "same"), (7, "words")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == 1][:8] == [1, 2, 3, 4, 5, 6, 7, 7]
    assert run(spark, docs[:1], items) == brute(docs[:1], items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_other_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, row int, item int")
    items = spark.createDataFrame([(9, "a", 3, 4)], "item_id long, text string, doc_id int, item string")
    assert [tuple(r) for r in L.search(docs, items).select("item_id", "rank", "doc_id").collect()] == [(9, 1, 1)]


def test_search_stops_before_all_postings(spark):
    """One rare term decides; postings of the common ones are left unread once nothing can reach the k-th best."""
    n = 5000
    weight = np.array([9000, 40, 30], np.int64)
    import pyarrow as pa

    lists = [[0, 1, 2] if k % 100 == 0 else [1, 2] for k in range(n)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array([50] * n), pa.array(lists, pa.list_(pa.int32())), pa.array([[1 + k % 3] * len(x) for k, x in enumerate(lists)], pa.list_(pa.int64()))], ["row", "doc_id", "n", "terms", "tfs"])
    shard = L._Shard([rows], weight, n, 50 * n)
    docs, score, read = shard.search(np.arange(3), np.ones(3, np.int64), 20, 60)
    assert read < 200 < 2 * n
    every = shard.complete(np.arange(n), np.arange(3), np.ones(3, np.int64))
    best = np.lexsort((np.arange(n), -every))[:20]
    assert set(best.tolist()) <= set(docs.tolist()) and (every[docs] == score).all()


def test_test_table_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF.replace('0.01', '0.001')}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted((tuple(r) for r in L.search(docs, items).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
