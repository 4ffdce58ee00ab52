import numpy as np
import pyarrow as pa
import pytest

from fundscope.llm import decontam as D
from fundscope.llm.words import Words

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew a strong potion for the tired king of spain"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_is_the_best_stretch():
    rng = np.random.default_rng(3)
    for _ in range(200):
        p, t = rng.integers(1, 5, rng.integers(1, 9)).tolist(), rng.integers(1, 5, rng.integers(0, 14)).tolist()
        d, a, b = D.edit_distance(p, t)
        best = min(levenshtein(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))
        assert d == best == levenshtein(p, t[a:b])


def test_planted_edits_are_found_at_the_recall():
    rng = np.random.default_rng(1)
    index = D.Index([(1, ITEM)], 0.8, 0.995)
    filler = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    found = 0
    for _ in range(150):
        edited = D.Index._edited(index.words[0], index.edits[0], rng)[0]
        w = Words(pa.array([""]))
        w.hashes = np.concatenate([filler[:100], edited, filler[100:]])
        w.offsets = np.array([0, len(w.hashes)])
        found += any(i == 0 for _, i, *_ in index.leaks(w))
    assert found >= 145


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(
        [
            (1, "before. " + ITEM.upper() + "! after", "x"),
            (2, ITEM.replace("lazy ", "").replace("strong", "weak"), "x"),
            (3, "nothing of the kind is said here by anyone at all", "x"),
            (4, None, "x"),
            (5, "", None),
            (None, ITEM, "x"),
            (1, "before. " + ITEM.upper() + "! after", "x"),
            (6, "filler " * 30_000 + ITEM + " filler" * 10, "x"),
        ],
        "doc_id long, text string, item_id string",
    )


def test_leaks_with_nulls_repeats_long_texts_and_clashing_names(spark, docs, rows):
    items = spark.createDataFrame([(10, ITEM, 1), (10, ITEM, 1), (11, None, 2), (12, "", 3), (13, "nothing here fits", 4), (None, ITEM, 5)], "item_id long, text string, doc_id int")
    got = rows(D.find_leaks(docs, items).filter("item_id = 10"), "doc_id", "edits", "word_from")
    assert got == sorted([(1, 0, 1), (1, 0, 1), (2, 2, 0), (6, 0, 30_000), (None, 0, 0)], key=repr)
    assert D.find_leaks(docs, items).filter("item_id is null").count() == 5
    kept = D.without_leaks(docs, items.filter("item_id is not null"))
    assert kept.columns == docs.columns and rows(kept, "doc_id") == [(3,), (4,), (5,)]


def test_blocks_of_items_give_the_same_rows(spark, docs, rows):
    items = spark.createDataFrame([(k, ITEM if k % 2 else f"other words {k} entirely") for k in range(8)], "item_id long, text string")
    assert rows(D.find_leaks(docs, items)) == rows(D.find_leaks(docs, items, block_bytes=100))


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs, none).count() == 0
    assert D.find_leaks(docs.limit(0), none).count() == 0


def test_brute_force_on_the_test_tables(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id, r.edits) for r in D.find_leaks(d, b).collect()}
    index = D.Index([(r.item_id, r.text) for r in b.collect()], 0.8, 0.9)
    rows_ = d.collect()
    want = set()
    for r, w in zip(rows_, Words(pa.array([r.text for r in rows_])).rows(), strict=True):
        for i, p, e in zip(index.ids, index.words, index.edits, strict=True):
            dist = D.edit_distance(p.tolist(), w.tolist())[0]
            if dist <= e:
                want.add((r.doc_id, i, dist))
    assert got == want


@pytest.mark.parametrize("walks, per_walk, item_words, trials", [(1, 1, 22, 150), (8, 32, 400, 60)])
def test_short_repetitions_fall_back_to_all_open_windows(walks, per_walk, item_words, trials):
    rng = np.random.default_rng(5)
    text = " ".join(f"word{k}" for k in range(item_words))
    index = D.Index([(1, text)], 0.8, 0.995, walks=walks, per_walk=per_walk)
    filler = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    for _ in range(trials):
        w = Words(pa.array([""]))
        w.hashes = np.concatenate([filler[:100], D.Index._edited(index.words[0], index.edits[0], rng)[0], filler[100:]])
        w.offsets = np.array([0, len(w.hashes)])
        assert any(i == 0 for _, i, *_ in index.leaks(w))


@pytest.mark.parametrize("item_words, items, trials", [(13, 30, 200), (60, 30, 200), (400, 8, 200), (1000, 4, 100), (2500, 2, 60)])
def test_recall_at_every_item_length(item_words, items, trials):
    rng = np.random.default_rng(item_words)
    index = D.Index([(k, " ".join(f"w{k}x{j}" for j in range(item_words))) for k in range(items)], 0.8, 0.995)
    assert all(c["recall"] >= 0.995 for c in index.classes)
    filler, found = rng.integers(1, 1 << 62, 300).astype(np.uint64), 0
    for t in range(trials):
        w = Words(pa.array([""]))
        w.hashes = np.concatenate([filler[:100], D.Index._edited(index.words[t % items], index.edits[t % items], rng)[0], filler[100:]])
        w.offsets = np.array([0, len(w.hashes)])
        found += any(i == t % items for _, i, *_ in index.leaks(w))
    assert found >= 0.995 * trials - 1


def test_recall_is_reported_and_index_bytes_bound_the_blocks(spark, docs, rows):
    items = spark.createDataFrame([(k, ITEM if k % 2 else f"some words {k} of their own entirely") for k in range(12)], "item_id long, text string")
    assert all(r["recall"] >= 0.995 and not r["exact"] for r in D.recall_reached(items))
    one, many = D._indexes(items, 0.8, 0.995, 4 << 20, 64 << 20), D._indexes(items, 0.8, 0.995, 4 << 20, 1000)
    assert len(one) == 1 and len(many) == 12
    assert rows(D.find_leaks(docs, items)) == rows(D.find_leaks(docs, items, index_bytes=1000))
    assert rows(D.without_leaks(docs, items), "doc_id") == rows(D.without_leaks(docs, items, index_bytes=1000), "doc_id")


def test_columns_of_any_name_are_kept(spark, rows):
    docs = spark.createDataFrame([(1, "clean text", "mine", 2), (2, ITEM, "x", 3)], "doc_id long, text string, searched string, _SEARCHED int")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert rows(D.without_leaks(docs, items)) == [(1, "clean text", "mine", 2)]
