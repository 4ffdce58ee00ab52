import random
import time

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from fundscope.llm import edit_counts as E


@pytest.fixture(scope="module")
def counter():
    return E.Counter(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_random_edits_equal_a_full_count(counter):
    rnd = random.Random(5)
    bits = ["'s", " ", "\n", "  a", "12", "é", "!!", "word ", "'", "ll", "", "\t", "語"]
    for text in ["", "a", "  ", "it's   we'll \n\n  x 123 4567!!", "some longer text, with words. " * 120]:
        tree = E.Tree(text, counter)
        for _ in range(60):
            a = rnd.randint(0, len(tree.text))
            b = a + rnd.choice([0, 0, 1, 3, 50, 400])
            new = "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 3, 40, 300])))
            want = tree.text[:a] + new + tree.text[b:]
            tree.edit(a, b, new)
            assert tree.text == want and tree.chars[1] == len(want) and tree.tokens[1] == sum(n for _, c in tree.leaves for n in c)
            assert tree.total == len(counter.encoding.encode_ordinary(want))


def test_an_edit_encodes_a_small_region(counter):
    tree = E.Tree("plain words follow each other here. " * 5000, counter)
    tree.edit(90_000, 90_003, "new")
    assert tree.encoded < 100


def test_rows_with_nulls_and_redactions(spark, counter):
    df = spark.createDataFrame([(1, "mail me at a.b@c.example.com or 10.0.0.12 now"), (2, None), (3, ""), (None, "x"), (1, "no data")], "doc_id long, text string")
    got = E.counts_with_edits(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, E.redactions).collect()
    by = sorted((r.doc_id or 0, r.n_edits, r.tokens_before, r.tokens_after, r.chars_after) for r in got)
    n = lambda s: len(counter.encoding.encode_ordinary(s))
    s = "mail me at [redacted] or [redacted] now"
    assert by == [(0, 0, 1, 1, 1), (1, 0, n("no data"), n("no data"), 7), (1, 2, n("mail me at a.b@c.example.com or 10.0.0.12 now"), n(s), len(s)), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


def test_clipped_edits_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abc", [(-5, 99, "xyz w"), (1, None, None)], 0)], "doc_id long, text string, edits array<struct<begin:int,end:int,text:string>>, n_edits int")
    df = df.withColumn("edits", F.filter("edits", lambda e: e["end"].isNotNull()))
    r = E.counts_with_edits(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).first()
    assert r.chars_after == 5 and r.n_edits == 1
    assert E.counts_with_edits(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_many_edits_of_a_long_text_stay_cheap(counter):
    text = "call 123456789012 or write to a.b@c.example.com now. " * 3000
    began = time.perf_counter()
    row = E._grown(text, None, None, 0, E.redactions(text), counter)
    want = E.REDACTED.sub("[redacted]", text)
    assert row[4] == 6000 and row[3] == len(counter.encoding.encode_ordinary(want)) and row[0] == want
    assert time.perf_counter() - began < 20


def test_kept_trees_take_a_second_batch_of_edits(spark, counter, tmp_path):
    """A batch on stored trees equals a full count and encodes the touched regions only, again and again."""
    rnd = random.Random(7)
    how = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    kind = "doc_id long, text string, edits array<struct<begin:int,end:int,text:string>>"
    texts = {k: "plain words follow 12 others, it's so.\n" * rnd.randrange(1, 400) for k in range(12)} | {50: "", 51: "one " * 60_000, 52: "no edits at all " * 50, 53: "語 é  \n" * 300}

    def some(text):
        return [(a, a + rnd.choice([0, 2, 9]), rnd.choice(["", "new", "'ll", " 7\n", "é語"])) for a in sorted(rnd.randrange(0, len(text) + 1) for _ in range(3))]

    def applied(text, edits):
        for a, b, new in edits:
            text = text[:a] + new + text[b:]
        return text

    trees = E.plant(spark.createDataFrame([(k, t, []) for k, t in texts.items()], kind), *how)
    for batch in range(3):
        trees.select("doc_id", "text", "lengths", "counts", "tokens").write.parquet(f"{tmp_path}/{batch}")
        kept = spark.read.parquet(f"{tmp_path}/{batch}")
        edits = {k: [] if k == 52 else some(t) for k, t in texts.items()}
        texts = {k: applied(t, edits[k]) for k, t in texts.items()}
        given = spark.createDataFrame(list(edits.items()), "k long, edits array<struct<begin:int,end:int,text:string>>")
        trees = E.edit(kept.join(given, kept.doc_id == given.k), *how)
        for r in trees.collect():
            assert r.text == texts[r.doc_id] and r.tokens == len(counter.encoding.encode_ordinary(r.text)), r.doc_id
            assert sum(E._unpacked(r.lengths)) == len(r.text) and sum(E._unpacked(r.counts)) == r.tokens
            assert r.n_edits == len(edits[r.doc_id]) and r.chars_encoded <= 300


def test_a_stored_tree_is_read_without_encoding(counter):
    known = E._grown("words of a text, kept as a tree. " * 100, None, None, 0, [], counter)

    class None_(E.Counter):
        def __init__(self):
            self.pattern = counter.pattern
            self.known = None

        def count(self, piece):
            return 1

    tree = E.Tree(known[0], None_(), E._unpacked(known[1]), E._unpacked(known[2]))
    assert tree.total == known[3] and tree.text == known[0]


def test_the_query_keeps_its_trees(spark, counter, tmp_path):
    from fundscope.llm import queries as Q

    texts = [(1, "see https://a.example/x?y=1 or mail a.b@c.example.com"), (2, None), (None, "https://only.example"), (3, "10.0.0.12 " * 5000 + "http://z.example")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    n = lambda s: len(counter.encoding.encode_ordinary(s))
    for r in Q.op3_token_counts(spark, str(tmp_path)).collect():
        text = dict(texts)[r.doc_id] or ""
        red = E.REDACTED.sub("[redacted]", text)
        bare = E.LINKS.sub("[link]", red)
        assert (r.tokens_before, r.tokens_after, r.tokens_unlinked, r.chars_redacted, r.chars_unlinked) == (n(text), n(red), n(bare), len(red), len(bare))
