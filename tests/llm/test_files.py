import gc
import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundscope.llm import mixing as X
from fundscope.llm import token_store as K
from fundscope.llm import warc as W
from fundscope.llm.common import open_fs, shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_of_the_tokenizer_equal_whole_texts():
    t = K.WordTokenizer(PATH, keep=50)
    texts = ["Don't STOP, it's 12.5%!", "naïve café Ünïcode  ß", "日本語 と English　mixed", "ΣΑΣ İstanbul", "a\x1cb c\x85d\xa0e", "x <|endoftext|> y", "é combining", "", " \n\t ", "word " * 500, "🙂🙂 ok", "²³ ½ ª"]
    want = [t.pack(t.whole.encode(s, add_special_tokens=False).ids) for s in texts]
    assert [t.encode(s) for s in texts] == want
    assert t.encode_all(pa.array([*texts, None])) == [*want, b""]
    assert t.encode_all(pa.array([], pa.string())) == [] and t.encode_all(pa.array(["plain"])) == t.encode_all(pa.array(["plain", "a\x1eb"]))[:1]


def test_random_texts_equal_the_library():
    rng = np.random.default_rng(8)
    signs = list("abcABCxyzéßÄñİıǅΣσς'’.,!?0123 \t\n\x85\xa0\u2003\u2028\u3000日本🙂e\u0301½²ªµ<|>")
    t = K.WordTokenizer(PATH)
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(4000)]
    assert t.encode_all(pa.array(texts)) == [t.pack(t.whole.encode(s, add_special_tokens=False).ids) for s in texts]


def test_encoding_holds_little_more_than_its_ids():
    """Distinct words and the ids of texts are worked on in parts: what is held beside parts and results is bounded."""
    import tracemalloc

    tokenizer = K.WordTokenizer(PATH)
    texts = pa.array([" ".join(f"w{(i * 977 + k * k) % 120_011}" for k in range(300)) for i in range(2_000)])
    want = tokenizer.encode_all(texts)
    tracemalloc.start()
    try:
        assert tokenizer.encode_all(texts) == want
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < sum(map(len, want)) + (24 << 20)


def test_a_worker_keeps_no_tokenizer_when_its_task_ends():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", None])], ["doc_id", "text"])
    gc.collect()
    gc.disable()
    try:
        assert sum(b.num_rows for b in K._compressor(PATH, b"", 2, 3)(iter([batch]))) == 2
        assert not [x for x in gc.get_objects() if isinstance(x, K.WordTokenizer)]
    finally:
        gc.enable()


def test_files_round_trip_in_order(spark):
    rows = [(5, "five words are in here", "a"), (1, None, "b"), (3, "", "c"), (2, "repeat me", "d"), (2, "repeat me", "d"), (None, "no id", "e"), (9, "long " * 50_000, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = K.digest(K.token_files(df, PATH, shard_bytes=64)).orderBy("start").collect()
    t, start = K.WordTokenizer(PATH), 0
    for (i, s, _), r in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), got, strict=True):
        ids = t.whole.encode(s or "", add_special_tokens=False).ids + [2]
        assert tuple(r) == (i, start, len(ids), K.crc_of(ids))
        start += len(ids)
    assert K.digest(K.token_files(df.limit(0), PATH)).count() == 0


def test_random_access_and_foreign_dictionary(spark):
    folder = shared_dir(spark, "t")
    df = spark.createDataFrame([(i, f"document number {i} says so") for i in range(50)], "doc_id long, text string")
    file = K.write_tokens(df.coalesce(1), folder, PATH).orderBy("part", "seq").first().file
    fs, root = open_fs(folder)
    name = next(x.base_name for x in fs.get_file_info(__import__("pyarrow").fs.FileSelector(root)) if x.base_name.startswith("dictionary"))
    data = fs.open_input_stream(f"{root}/{name}").read()
    shard = K.Shard(fs, f"{root}/{file}", data)
    assert shard[7].tolist() == [*K.WordTokenizer(PATH).whole.encode("document number 7 says so", add_special_tokens=False).ids, 2]
    with pytest.raises(ValueError):
        K.Shard(fs, f"{root}/{file}", data + b"x")


def test_many_rows_without_an_id_make_several_ranges_and_other_tokenizers_give_their_ids(spark, tmp_path):
    import json

    from tokenizers import Tokenizer

    df = spark.createDataFrame([(None, f"row {k % 50}") for k in range(3000)] + [(k, "an id") for k in range(5)], "doc_id long, text string").repartition(4)
    folder = shared_dir(spark, "t")
    manifest = K.write_tokens(df, folder, PATH, shard_bytes=5000)
    assert manifest.select("part").distinct().count() > 1
    got = K.read_tokens(spark, folder, task_bytes=2000).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 3000 + list(range(5))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    assert K.read_tokens(spark, folder, task_bytes=2000).rdd.getNumPartitions() > 3

    spec = json.load(open(PATH))
    spec["normalizer"] = {"type": "Sequence", "normalizers": [{"type": "NFKC"}, {"type": "Lowercase"}]}
    other = str(tmp_path / "other.json")
    json.dump(spec, open(other, "w"))
    t, whole = K.WordTokenizer(other), Tokenizer.from_file(other)
    for text in ("Plain words", "ﬁne ½ ①  x"):
        assert t.encode(text) == t.pack(whole.encode(text, add_special_tokens=False).ids)
    assert not t.by_word and K.WordTokenizer(PATH).by_word


def test_warc_hot_payload_and_long_page(spark):
    hot, long = "<p>" + "h" * 1200, "<p>" + "long page " * 300_000
    rows = [(k, "u", hot) for k in range(2000)] + [(5000 + k, "", f"<p>{k}" + "x" * 1100) for k in range(50)] + [(9000, "l", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    folder = shared_dir(spark, "w")
    W.write_warc(df, folder)
    back = W.read_warc(spark, folder, task_bytes=10_000)
    assert back.rdd.getNumPartitions() > 3
    got = back.collect()
    assert len(got) == len(rows) and sum(r.record_type == "revisit" for r in got) == 1999
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1999}
    assert {r.url for r in got if 5000 <= r.page_id < 5003} == {"urn:page:5000", "urn:page:5001", "urn:page:5002"}
    assert next(r for r in got if r.page_id == 9000).payload_bytes == len(long)


def test_warc_round_trip(spark, rows):
    big, other = "<p>" + "a" * 2000, "<p>" + "é" * 1500
    data = [(1, "http://a/", big), (2, "http://b/", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "line\r\nbreak", other), (None, "n", big), (3, "again", big)]
    df = spark.createDataFrame([(i, u, h, 0) for i, u, h in data], "page_id long, url string, html string, winner int").repartition(3)
    folder = shared_dir(spark, "w")
    index = W.write_warc(df, folder, file_bytes=500)
    got = W.read_warc(spark, folder, gap=10, most=3000)
    short = rows(got, "page_id", "payload_bytes", "record_type", "refers_to")
    n = len(big)
    assert short == sorted([(1, n, "revisit", 3), (2, n, "revisit", 3), (3, n, "response", None), (3, n, "response", None), (None, n, "revisit", 3), (4, 5, "response", None), (5, 5, "response", None), (6, 0, "response", None), (7, 0, "response", None), (8, 3 + 3000, "response", None)], key=repr)
    r = got.filter("page_id = 8").first()
    assert bytes(r.payload) == other.encode() and r.payload_digest == hashlib.sha1(other.encode()).hexdigest()
    assert rows(W.read_warc(spark, folder, index.filter("page_id in (4, 8)")), "page_id") == [(4,), (8,)]
    assert W.warc_round_trip(df.limit(0)).count() == 0


def test_ranges_coalesce_within_limits():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 100, 10), ("a", 112, 10), ("b", 0, 5)]
    assert [(f, s, e, len(m)) for f, s, e, m in W.ranges(iter(rows), 5, 1000)] == [("a", 0, 20, 2), ("a", 100, 122, 2), ("b", 0, 5, 1)]
    assert len(list(W.ranges(iter(rows), 1000, 15))) == 5


def water_fill(sizes, weights, cap=3.0):
    """Reshare the excess by weight until none is above."""
    total, fixed, target = float(sum(sizes)), set(), [0.0] * len(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(cap * sizes[i] for i in fixed)
        for i in free:
            target[i] = left * weights[i] / sum(weights[j] for j in free)
        over = [i for i in free if target[i] > cap * sizes[i]]
        if not over:
            return target
        for i in over:
            target[i] = cap * sizes[i]
        fixed |= set(over)


def test_targets_equal_resharing(spark):
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 40):
        sizes = np.maximum(0, rng.lognormal(5, 2, n).astype(int) - 20).tolist()
        if not sum(sizes):
            sizes[0] = 7
        df = spark.createDataFrame([(f"s{k:03d}", s) for k, s in enumerate(sizes)], "source string, source_size long")
        got = [r.target for r in X.with_targets(df).orderBy("source").collect()]
        assert np.allclose(got, water_fill(sizes, [k % 3 + 1 for k in range(n)]), atol=1e-4)


def test_tree_keeps_quotas_and_balance():
    quotas = np.array([100, 3, 0, 57])
    leaves = X.splitting_tree(quotas, 3, 1)
    assert (leaves.sum(0) == quotas).all() and (leaves >= 0).all()
    assert leaves.sum(1).max() - leaves.sum(1).min() <= 1


def test_mix_takes_the_targets_and_blocks_are_disjoint(spark):
    rows = [(i, ["a", "b", None, "zz"][i % 4], "w " * (1 + i * 7 % 90)) for i in range(400)] + [(1000, "one", "x y z"), (1001, "b", None), (1002, "b", ""), (None, "b", "p q"), (5, "b", "again"), (5, "b", "again")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, source string, text string, size int")
    pieces = X.mix(df, block_words=64, shard_words=2000)
    got = X.taken(pieces).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by = pieces.groupBy("source").agg(F.sum("words").alias("w"), F.max("target").alias("t")).collect()
    assert all(abs(r.w - r.t) <= 1 for r in by)
    shards = pieces.filter("shard is not null").groupBy("shard").agg(F.sum("words").alias("w")).collect()
    assert len(shards) >= 2
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, X.taken(X.mix(df, block_words=64, shard_words=2000)).collect()), key=repr)
    assert X.mix(df.limit(0)).count() == 0


def test_mix_against_a_direct_computation(spark):
    """Order, passes, blocks and words anew; then what the tree promises of the shards."""
    import xxhash

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rng = np.random.default_rng(4)
    rows = [(int(i), ["a", "b", "c", None][i % 4], "w " * int(rng.integers(0, 30)) + str(i)) for i in range(600)]
    rows += [(7, "b", "the same row")] * 3 + [(None, "c", f"no id {k}") for k in range(4)] + [(9000, "tiny", "one"), (9001, "a", None), (9002, "a", ""), (9003, None, "long " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    pieces = X.mix(df, block_words=64, shard_words=1000)
    got = pieces.collect()

    def key(r):
        content = "" if r[2] is None else str(np.uint64(xxhash.xxh64_intdigest(r[2].encode(), seed=42)).astype(np.int64))
        return hashlib.md5(f"6:{'' if r[0] is None else r[0]}:{content}".encode()).hexdigest()

    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(words(r[2]) for r in rows if r[1] == s) for s in names}
    target = dict(zip(names, water_fill([size[s] for s in names], [k % 3 + 1 for k in range(len(names))]), strict=True))
    want, quota = [], {}
    for s in names:
        whole, at = int(target[s] + 0.5), 0
        quota[s] = -(-whole // 64)
        for turn in range(3):
            for r in sorted((r for r in rows if r[1] == s), key=key):
                if (n := words(r[2])) and at < whole:
                    want.append((r[0], s, turn, at // 64, min(n, whole - at)))
                    at += n
    assert sorted(((r.doc_id, r.source, r.turn, r.block, r.words) for r in got if r.shard is not None), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]

    # every block lies in one shard; shards have the tree's quotas, which differ by one block at most
    home = {}
    for r in got:
        if r.shard is not None:
            assert home.setdefault((r.source, r.block), r.shard) == r.shard
    n_shards = 1 << int(np.log2(-(-sum(size.values()) // 1000)))
    leaves = X.splitting_tree(np.array([quota[s] for s in names]), int(np.log2(n_shards)), 6)
    for k, s in enumerate(names):
        order = X.permute(np.arange(quota[s]), quota[s], 6, s)
        assert sorted(order.tolist()) == list(range(quota[s]))
        shards = np.searchsorted(np.cumsum(leaves[:, k]), order, "right")
        assert np.bincount(shards, minlength=n_shards).tolist() == leaves[:, k].tolist()
        assert all(shards[b] == home[s, b] for b in range(quota[s]) if (s, b) in home)
    # shards are shuffled, and sources have permutations of their own
    first = sorted((r for r in got if r.shard == 0), key=lambda r: r.place)
    assert [(r.source, r.turn, r.block) for r in first] != sorted(((r.source, r.turn, r.block) for r in first), key=repr)
    assert X.permute(np.arange(500), 500, 6, "a").tolist() != X.permute(np.arange(500), 500, 6, "b").tolist()

    # the digest adds the pieces up, and the rows of the shards are those pieces
    digest = {}
    for r in X.taken(pieces).collect():
        digest.setdefault(r.doc_id, []).append((r.size, r.taken, r.pieces, r.shards))
    by_row = {}
    for r in got:
        by_row.setdefault((r.doc_id, r.row), []).append(r)
    for (i, _), ps in by_row.items():
        real = sorted((p for p in ps if p.shard is not None), key=lambda p: p.turn)
        assert (ps[0].size, sum(p.words for p in ps), len(real), ",".join(f"{p.shard}:{p.place}" for p in real)) in digest[i]
    texts = X.mixed(df, block_words=64, shard_words=1000).collect()
    assert sorted((r.doc_id or -1, words(r.text)) for r in texts) == sorted((i or -1, n) for i, _, _, _, n in want)


def test_many_equal_rows_spread_over_cells(spark):
    rows = [(None, "a", "equal words here")] * 5000 + [(i, "a", "others " * 5) for i in range(50)]
    df = spark.createDataFrame([(k, i, s, 3 if i is None else 5, 1 if i is None else i + 10) for k, (i, s, _) in enumerate(rows)], "row long, doc_id long, source string, size long, content long")
    got = X.permuted(df, "6:", len(rows), cell_rows=64, most_hot=10).orderBy("begin").collect()
    assert [r.begin for r in got] == np.concatenate([[0], np.cumsum([r["size"] for r in got])[:-1]]).tolist()


def test_words_are_split_at_ascii_space_only(spark):
    df = spark.createDataFrame([("a b c\td\x0be\n",), (None,), ("",), ("　",)], "t string")
    assert [r.n for r in df.select(X.word_count(F.col("t")).alias("n")).collect()] == [4, 0, 0, 1]
