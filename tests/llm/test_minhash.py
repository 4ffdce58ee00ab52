import re
from itertools import combinations

import numpy as np
import pytest

from fundscope.llm import minhash as M
from fundscope.llm.common import shared_dir, written


def brute(rows):
    """(id, size, component) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set())
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links = 0
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
            links += 1
    name = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            name[find(k)] = min(name.get(find(k), i), i)
    return sorted(((i, len(sets[k]), name.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr), links


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.deduplicated(docs, **options).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)


def near_copies(seed, groups, copies, words, edits):
    """Groups of texts, each copy with words of its own in some places; half of the groups lack their original."""
    rng, out = np.random.default_rng(seed), []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(words)]
        texts = [base] if g % 2 else []
        for c in range(copies):
            w = list(base)
            for at in rng.choice(words, int(rng.integers(1, edits + 1)), replace=False).tolist():
                w[at] = f"x{g}_{c}_{at}"
            texts.append(w)
        out += [" ".join(w) for w in texts]
    order = rng.permutation(len(out)).tolist()
    return [(i, out[k]) for i, k in enumerate(order)]


def test_components_of_near_copies_equal_brute_force(spark):
    rows = near_copies(1, 8, 25, 250, 4)
    want, links = brute(rows)
    assert links > 100 and 8 < len({w[2] for w in want}) < len(rows)
    assert run(spark, rows) == want


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M.left_over, "__defaults__", (8, 1 << 20))
    rows = near_copies(2, 2, 60, 120, 5)
    assert run(spark, rows) == brute(rows)[0]


def test_chain_whose_ends_are_far_apart(spark):
    """Each text replaces two more words at the end of the one before: neighbours are linked, ends share nothing."""
    words = [f"w{k}" for k in range(400)]
    rows = [(50 - k, " ".join(words[4 * k : 4 * k + 100])) for k in range(50)]
    want, links = brute(rows)
    assert links >= 49 and {w[2] for w in want} == {1}
    assert run(spark, rows) == want


@pytest.mark.parametrize("size", [7, 9, 13, 20, 60, 300])
def test_pairs_of_just_the_wanted_similarity_meet(size):
    rng, common = np.random.default_rng(size), -(-85 * size // 100)
    one, two = [], []
    for _ in range(400):
        x = rng.integers(0, 2**64, size, dtype=np.uint64)
        k = int(rng.integers(common, size + 1))
        one.append(np.sort(x[:k]))
        two.append(np.sort(np.concatenate([x[:common], x[k:]])))
    a, b = M.signatures(one), M.signatures(two)
    assert (M.bands(a) == M.bands(b)).any(axis=1).all()
    agree = (a == b).mean(axis=1)
    assert abs(agree.mean() - common / size) < 0.01 and agree.min() >= 0.85 - 5 * M.DEVIATION


def test_stars_bound_the_edges(spark):
    """A group of n near copies of one text gives about n edges, not n * n."""
    rows = near_copies(4, 2, 300, 200, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, confirm = [], M.confirmed

    def counted(edges, *args):
        edges = written(edges, shared_dir(spark, "seen"))
        seen.append(edges.count())
        return confirm(edges, *args)

    M.confirmed = counted
    try:
        got = M.deduplicated(docs).collect()
    finally:
        M.confirmed = confirm
    assert len({r.component_id for r in got}) == 2
    assert sum(seen) < 5 * len(rows)  # all pairs would be 150 times as many


def test_edges_of_the_input(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (3, text.upper()), (9, text + "\t\n"), (9, text), (1, None), (2, ""), (4, " \x0b"), (6, "one two"), (7, "two one"), (8, "one  two"), (None, text), (None, "alone"), (10, text + "!"), (11, "É a"), (12, "é a"), (13, "long " * 60_000), (14, "long " * 70_000)]
    got = run(spark, rows)
    assert got == brute(rows)[0]
    assert (None, 3, 3) in got and (11, 1, 11) in got and (14, 1, 13) in got and (1, 0, 1) in got and (2, 0, 2) in got
    clash = spark.createDataFrame([(1, text, 5, 6), (2, text, 7, 8)], "doc_id long, text string, rid int, n int")
    assert {r.component_id for r in M.deduplicated(clash).collect()} == {1}
    assert M.deduplicated(clash.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 16])
def test_what_stars_miss_is_found(spark, monkeypatch, block):
    """Without any star, the comparison of what is left gives all components alone, in one block and in several."""
    monkeypatch.setattr(M, "star_edges", lambda met: met.select(met.rid.alias("u"), met.rid.alias("v")).limit(0))
    monkeypatch.setattr(M.left_over, "__defaults__", (block, 1 << 20))
    rows = near_copies(5, 3, 25, 250, 4)
    assert run(spark, rows) == brute(rows)[0]
