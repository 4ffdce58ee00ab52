import hashlib
import zlib

import numpy as np
import pytest
from conftest import SF

from fundscope.llm import queries as Q
from fundscope.llm import runs as R


def brute(words, least=24, exponent=3):
    """Runs by trying every period, the smallest one of a stretch."""
    n, out = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            out.setdefault((i, j + p - i), p)
            i = j
    return sorted(((a, n, p) for (a, n), p in out.items() if n >= max(least, exponent * p) and not any(p % q == 0 and (a, n) == (b, m) for (b, m), q in out.items() if q < p)), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {k for a, n, p in runs for k in range(a + p, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in drop)


def planted(text, doc_id):
    words = (text or "").encode().split()
    words, h = [w.decode() for w in words], zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row(doc_id, words):
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(collapsed(words, runs)))


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_words_equal_brute_force(letters):
    rng = np.random.default_rng(letters)
    for trial in range(300):
        n = int(rng.integers(1, 90))
        w = rng.integers(0, letters, n).tolist()
        if trial % 2:
            # repeated pieces within other words
            piece = rng.integers(0, letters, int(rng.integers(1, 9))).tolist()
            at = int(rng.integers(0, n))
            w = w[:at] + piece * int(rng.integers(2, 9)) + piece[: int(rng.integers(0, len(piece)))] + w[at:]
        assert R.Sequence(w).runs(6, 3) == brute(w, 6), w
        assert R.Sequence(w).runs(24, 4) == brute(w, 24, 4)


def test_clashing_hashes_are_seen_by_the_words(monkeypatch):
    """With a hash that calls everything equal, only the comparison of words is left."""
    monkeypatch.setattr(R, "mix", lambda x: np.zeros_like(x))
    for w in ([0, 1] * 20 + [2] + [0, 1] * 20, [0] * 30 + [1] + [0] * 30, list(range(50))):
        s = R.Sequence(w)
        for a in range(0, len(w), 3):
            for b in range(a + 1, len(w), 5):
                k = 0
                while b + k < len(w) and w[a + k] == w[b + k]:
                    k += 1
                assert s._search(a, b, len(w) - b, 1) <= k


def test_long_periodic_texts_take_time_in_proportion():
    import time

    began = time.process_time()
    assert R.Sequence([0] * 300_000).runs(24, 3) == [(0, 300_000, 1)]
    assert R.Sequence([0, 1, 0] * 100_000).runs(24, 3) == [(0, 300_000, 3)]
    fib = [0], [0, 1]
    while len(fib[1]) < 100_000:
        fib = fib[1], fib[1] + fib[0]
    assert len(R.Sequence(fib[1]).runs(24, 3)) > 1000
    assert time.process_time() - began < 60


def test_query_equals_brute_force(spark):
    folder = SF.replace("0.01", "0.001")
    got = {r.doc_id: tuple(r) for r in Q.op13_periodic_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = planted(d.text, d.doc_id)
        if len(words) <= 1500:
            assert got[d.doc_id] == row(d.doc_id, words)
            some += got[d.doc_id][1] > 0
    assert some > 5


def test_edges(spark):
    loop = "a b c " * 20
    rows = [(1, loop, 1), (1, loop, 2), (2, None, 3), (3, "", 4), (4, " \t\n", 5), (None, loop, 6), (5, "x " * 23, 7), (6, "x " * 24, 8), (7, "A a " * 30 + "　", 9), (8, "w " * 200_000, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = R.periodic_runs(df, carry=["doc_id"])
    got = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in found.collect()}
    assert got == {(1, "a b c"): [(0, 60, 3)], (2, ""): [], (3, ""): [], (4, ""): [], (None, "a b c"): [(0, 60, 3)], (5, " ".join("x" * 23)): [], (6, "x"): [(0, 24, 1)], (7, "A a 　"): [(0, 60, 2)], (8, "w"): [(0, 200_000, 1)]}
    assert found.count() == len(rows) and R.digest(found).filter("runs_sha256 is null or collapsed_sha256 is null").count() == 0
    assert R.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        R.periodic_runs(df, min_exponent=2)
