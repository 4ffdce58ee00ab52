import corpus_pipeline as C
import duckdb
import pytest
from conftest import SF

from fundscope.llm import queries as Q


def test_stages_keep_columns_and_take_effect(spark):
    docs = C.load(spark, "/root/testdata/sf0.001", "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in C.STAGES[:-1]:
        docs = C.written(stage(spark, docs, "/root/testdata/sf0.001"), C.shared_dir(spark, name))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    out = C.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert out.count() == counts[4]


def test_mix_stage_cuts_at_words(spark):
    rows = [(i, "  ".join(f"w{i}x{k}" for k in range(50)) + " ", "en", "ab"[i % 2], 1, 5) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _other int")
    got = C.mix_sources(spark, docs, "").collect()
    whole = {r[0]: r[1] for r in rows}
    assert all(whole[r.doc_id].startswith(r.text) for r in got)
    words = {s: sum(len(r.text.split()) for r in got if r.source == s) for s in "ab"}
    assert words == {"a": 333, "b": 667}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = Q.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({Q.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(want, key=repr)


def test_one_row_of_each_class_with_repeated_and_null_ids(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    rows = [(1, one), (1, one), (2, one), (2, two), (None, one), (None, three), (None, three), (5, "short"), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in C.keep_one_of_each_class(spark, docs, "").collect()), key=repr)
    assert got == sorted([(1, one), (2, two), (None, three), (5, "short"), (6, None)], key=repr)


def test_mix_counts_belong_to_their_rows(spark):
    sizes = [(1, 40, "a"), (1, 10, "a"), (None, 30, "a"), (None, 5, "b"), (2, 200, "b"), (1, 7, "b")]
    docs = spark.createDataFrame([(i, " ".join(f"w{n}x{k}" for k in range(n)), "en", s, 1) for i, n, s in sizes], "doc_id long, text string, lang string, source string, n_chars long")
    want = dict.fromkeys("ab", 0)
    for r in C.mixing.taken(C.mixing.mix(docs)).withColumn("s", C.F.when(C.F.col("source_size") == 80, "a").otherwise("b")).collect():
        want[r.s] += r.taken
    got = dict.fromkeys("ab", 0)
    for r in C.mix_sources(spark, docs, "").collect():
        got[r.source] += len(r.text.split())
    assert got == want


EDGE = "doc_id long, text string, lang string, source string, n_chars long, _row long, row_key int, shard int, place string, searched string, scored string, cell int, _file string, size int"


@pytest.fixture
def edge(spark):
    """Null columns, empty and very long texts, repeated rows and ids, and columns with the names that stages use."""
    good = " ".join(f"prose{k}" for k in range(80))
    rows = [(1, good), (1, good), (2, None), (3, ""), (None, "no id here"), (None, None), (4, "long text " * 30_000), (5, "a b c"), (5, "d e f"), (6, good + " more")]
    return spark.createDataFrame([(i, t, None if k % 3 else "en", None if k % 4 == 0 else "s", None if t is None else len(t), -k, k, 7, "p", "q", "r", k, "f", k) for k, (i, t) in enumerate(rows)], EDGE)


@pytest.mark.parametrize("stage", C.STAGES[:-1], ids=lambda s: s[0])
def test_stages_on_odd_rows_and_empty_tables(spark, edge, stage):
    folder = "/root/testdata/sf0.001"
    got = stage[1](spark, edge, folder)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in edge.schema]
    # rows stay whole: columns other than the text and its length are those of a row of the input
    plain = lambda r: tuple(v for f, v in zip(got.columns, r, strict=True) if f not in ("text", "n_chars"))
    assert {plain(r) for r in got.collect()} <= {plain(r) for r in edge.collect()}
    none = stage[1](spark, edge.limit(0), folder)
    assert none.columns == edge.columns and none.count() == 0


def test_what_the_stages_make_of_odd_rows(spark, edge):
    folder = "/root/testdata/sf0.001"
    kept = sorted(r.row_key for r in C.keep_one_of_each_class(spark, edge, folder).collect())
    assert kept == [0, 2, 3, 4, 5, 6, 7, 8]  # the repeated row and the near copy go
    assert sorted(r.row_key for r in C.drop_leaks(spark, edge, folder).collect()) == list(range(10))
    mixed = C.mix_sources(spark, edge, folder).collect()
    assert not {2, 3, 5} & {r.row_key for r in mixed}
    assert all(r.n_chars == len(r.text) for r in mixed)
    tokens = C.write_token_files(spark, edge, folder).collect()
    assert sorted(((r.doc_id or 0) for r in tokens)) == [0, 0, 1, 1, 2, 3, 4, 5, 5, 6]
    assert C.write_token_files(spark, edge.limit(0), folder).count() == 0


def test_five_rows_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    docs = spark.createDataFrame([(5, a), (5, a), (3, b), (7, b), (7, c)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in C.keep_one_of_each_class(spark, docs, "").collect()) == [(3, b), (5, a), (7, c)]


def test_mix_stage_is_shard_by_shard(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(40)), "en", "ab"[i % 2], 1) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    keyed = C.with_row_key(docs, "k")
    pieces = {(r.doc_id, r.turn): r for r in C.mixing.mix(keyed, row="k", block_words=256, shard_words=2000).collect()}
    shards, turns = [], {}
    for r in C.mixing.mixed(docs, block_words=256, shard_words=2000).collect():
        here = [p for (i, _), p in pieces.items() if i == r.doc_id and p.words == len(r.text.split())]
        shards.append({p.shard for p in here})
        turns[r.doc_id] = turns.get(r.doc_id, 0) + 1
    assert turns == {i: sum(k[0] == i and p.words > 0 for k, p in pieces.items()) for i in turns}
    assert len(set().union(*shards)) >= 4


def test_pipeline_against_a_direct_computation(spark, tmp_path):
    """All five stages anew, with plain loops: scores, all pairs, all edit distances, the repeated streams, the library's ids."""
    import hashlib
    import re

    import numpy as np
    import pyarrow as pa
    import xxhash
    from test_files import water_fill
    from test_search import brute

    from fundscope.llm import decontam as D
    from fundscope.llm import quality
    from fundscope.llm import token_store as K
    from fundscope.llm.words import Words

    folder = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.limit(6).collect()
    more = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd[:2]] + [(None, odd[2].text, None, None, 1), (None, odd[3].text + " and a few more words", "en", "src0", 2), (99_991, None, "en", "src1", None), (99_992, "", "en", None, 0)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")

    model = quality.fit(table, spark.read.parquet(f"{tmp_path}/labels.parquet").filter(~quality.held_out(C.F.col("doc_id"))))
    zs = model.compressors()

    def score(text):
        raw = (text or "").encode()
        good, bad = (sum(len(z.compress(raw[k : k + quality.PIECE])) for k in range(0, len(raw), quality.PIECE)) for z in zs)
        return 1 / (1 + np.exp(-(model.bias + model.slope * (bad - good) / (len(raw) + model.shrink) + model.filled * len(raw) / (len(raw) + model.shrink))))

    rows = [(r.doc_id, r.text, r.source) for r in table.collect() if score(r.text) >= 0.7]

    label = list(range(len(rows)))
    near = brute([t for _, t, _ in rows])
    for _ in rows:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
    classes = {}
    for i, c in enumerate(label):
        classes.setdefault(c, []).append(rows[i])
    rows = [min(c, key=lambda r: (r[0] is None, r[0] or 0)) for c in classes.values()]

    items = list(Words(pa.array([r.text for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()])).rows())
    leaked = lambda w: any(len(p) and D.edit_distance(p.tolist(), w.tolist())[0] <= D.allowed(len(p), 0.8) for p in items)
    rows = [r for r, w in zip(rows, Words(pa.array([t for _, t, _ in rows], pa.string())).rows(), strict=True) if not leaked(w)]

    word = re.compile(r"[^\x20\x09-\x0D]+")
    size = lambda t: len(word.findall(t or ""))

    def key(r):
        content = "" if r[1] is None else str(np.uint64(xxhash.xxh64_intdigest(r[1].encode(), seed=42)).astype(np.int64))
        return hashlib.md5(f"6:{'' if r[0] is None else r[0]}:{content}".encode()).hexdigest()

    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    target = water_fill([sum(size(t) for _, t, x in rows if x == s) for s in names], [k % 3 + 1 for k in range(len(names))])
    taken = []
    for s, wanted in zip(names, target, strict=True):
        whole, at = int(wanted + 0.5), 0
        for _ in range(3):
            for r in sorted((r for r in rows if r[2] == s and size(r[1])), key=key):
                if (n := min(size(r[1]), whole - at)) > 0:
                    taken.append((r[0], r[1] if n == size(r[1]) else r[1][: [m.end() for m in word.finditer(r[1])][n - 1]]))
                    at += n

    whole = K.WordTokenizer(Q.tokenizer()).whole
    want = []
    for i, t in taken:
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, len(ids), K.crc_of(ids)))
    got = C.run(spark, str(tmp_path)).orderBy("start").collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got) and 50 < len(rows) < 200
