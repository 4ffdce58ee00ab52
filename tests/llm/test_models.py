import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from fundscope.llm import quality as Q
from fundscope.llm import toxicity as T


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = Q.classify(docs, labels).filter("held_out").join(labels, "doc_id").select("quality", "predicted").toPandas()
    assert (got.quality == got.predicted).mean() > 0.97
    assert got[got.quality == 1].predicted.mean() > 0.98


def test_quality_edges(spark, rows):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "words " * 40_000, 0.5), (None, "text", 0.5), (1, None, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, None), (9, 0), (None, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    got = Q.classify(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert Q.classify(docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0.5
    assert Q.classify(docs.limit(0), labels).count() == 0


def test_quality_labels_of_held_out_ids_are_not_used(spark, rows):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(200), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows(Q.classify(docs, labels)) == rows(Q.classify(docs, flipped))


def test_ordinal_regression_orders_four_grades():
    rng = np.random.default_rng(0)
    n, width, true = 4000, 6, np.array([2.0, 1.0, 0.5, -1.0, 0.0, 0.0])
    x = rng.random((n, width)) < 0.4
    y = np.searchsorted([0.0, 1.0, 2.0], x @ true + rng.logistic(size=n) * 0.5)
    r, c = np.nonzero(x)
    w, t = T.fit_ordinal(r, c, n, width, y, 4, penalty=0.1, rounds=3000)
    assert np.all(np.diff(t) > 0)
    assert np.corrcoef(w, true)[0, 1] > 0.98
    model = T.Model(np.arange(4), np.arange(width).astype(np.uint64), w, t)
    assert np.corrcoef(model.severity(x @ w), y)[0, 1] > 0.7


def test_toxicity_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = labels.filter(~Q.held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("grade"))
    got = T.score(docs, T.fit(docs, known)).join(labels.filter(Q.held_out(F.col("doc_id"))), "doc_id").select("toxic", "severity").toPandas()
    flagged = got.severity >= 0.1
    assert flagged[got.toxic == 1].mean() > 0.8
    assert flagged[got.toxic == 0].mean() < 0.02


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "vile words here", 3), (None, "calm", 3)], "doc_id long, text string, grade int")
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert {r.severity for r in T.score(docs, T.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 2), (2, 2), (3, None), (None, 0)], "doc_id long, grade int")
    assert {r.severity for r in T.score(docs, T.fit(docs, one)).collect()} == {2.0}
    assert T.score(docs.limit(0), T.fit(docs, one)).count() == 0


def test_ordinal_regression_weights_are_repeated_rows():
    rng = np.random.default_rng(2)
    x, y, many = rng.random((300, 4)) < 0.4, rng.integers(0, 3, 300), rng.integers(1, 4, 300)
    r, c = np.nonzero(x)
    r_, c_ = np.nonzero(np.repeat(x, many, axis=0))
    got = T.fit_ordinal(r, c, 300, 4, y, 3, weight=many.astype(float))
    want = T.fit_ordinal(r_, c_, int(many.sum()), 4, np.repeat(y, many), 3)
    assert np.allclose(got[0], want[0], atol=1e-6) and np.allclose(got[1], want[1], atol=1e-6)


def test_toxicity_keeps_shares_when_a_grade_is_drawn_in_part(spark):
    rng = np.random.default_rng(3)
    grade = (rng.random(3000) < 0.1).astype(int)
    bad = rng.random(3000) < np.where(grade == 1, 0.5, 0.05)
    rows = [(i, f"plain text w{i % 7} {'vile' if b else 'mild'}", int(g)) for i, (b, g) in enumerate(zip(bad, grade, strict=True))]
    table = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    mean = lambda **options: T.score(table, T.fit(table.select("doc_id", "text"), table.select("doc_id", "grade"), **options)).agg(F.avg("severity")).first()[0]
    assert abs(mean() - grade.mean()) < 0.01
    assert abs(mean(sample_rows=2 * int(grade.sum())) - grade.mean()) < 0.03


def test_toxicity_with_many_grades_loses_none(spark):
    docs = spark.createDataFrame([(i, "grade " * (i % 100 + 1) + f"w{i % 100 // 10}") for i in range(1000)], "doc_id long, text string")
    model = T.fit(docs, docs.select("doc_id", (F.col("doc_id") % 100).cast("int").alias("grade")), sample_rows=500)
    assert model.grades.tolist() == list(range(100)) and len(model.thresholds) == 99
    got = T.score(docs, model).select("doc_id", "severity").toPandas()
    assert abs(got.severity.mean() - 49.5) < 2 and np.corrcoef(got.severity, got.doc_id % 100)[0, 1] > 0.9


WORDS = "river stone market window garden signal copper lantern meadow harbour".split()


def _labelled(n, rng):
    """(doc_id, text, label): label 1 leans to the first words and to lower-case prose, label 0 to the last ones."""
    out = []
    for i in range(n):
        y = int(rng.random() < 0.6)
        p = np.linspace(3, 1, 10) if y else np.linspace(1, 3, 10)
        out.append((i, " ".join(rng.choice(WORDS, 30, p=p / p.sum())) + (f" {i}" if y else f" !! {i * 7919}"), y))
    return out


def test_quality_against_a_direct_computation(spark):
    """Model and scores computed anew from the method's words, with one text longer than all pieces together."""
    import zstandard

    rows = _labelled(240, np.random.default_rng(5))
    rows += [(1000, "long tale of the " + " ".join(f"{w}{k}" for k in range(900) for w in WORDS[:3]), 1), (1001, "", 1), (1002, None, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000 + k, 0) for k in range(50)], "doc_id long, quality int")
    part = {r.doc_id: r.part for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(4)).bitwiseAND(1).alias("part")).collect()}
    pieces = {0: [], 1: []}
    for i, t, y in rows:
        if part[i] == 0 and t:
            pieces[y] += [t[k : k + 2048].encode() for k in range(0, len(t), 2048)]
    dicts = [zstandard.ZstdCompressionDict(zstandard.train_dictionary(112_640, pieces[y], k=64, d=8).as_bytes()) if len(pieces[y]) > 7 else None for y in (1, 0)]

    def features(t):
        raw = (t or "").encode()
        size = [0, 0]
        for k in range(0, len(raw), 2048):
            for j, d in enumerate(dicts):
                size[j] += len(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(raw[k : k + 2048]))
        return (size[1] - size[0]) / (len(raw) + 64), len(raw) / (len(raw) + 64)

    curve = [(*features(t), y) for i, t, y in rows if part[i] == 1 and t is not None]
    x, f, y = map(np.array, zip(*curve, strict=True))
    scale, w = x.std(), np.zeros(3)
    for _ in range(200_000):  # plain gradient ascent of the penalised likelihood
        design = np.stack([np.ones_like(x), x / scale, f], 1)
        g = design.T @ (y - 1 / (1 + np.exp(-design @ w))) - 1e-2 * w
        w = w + 0.02 * g
        if np.abs(g).max() < 1e-9:
            break
    known = [y for _, t, y in rows if t is not None]
    shift = np.log(sum(known) / (len(known) - sum(known)) / (y.mean() / (1 - y.mean())))
    model = Q.fit(docs, labels)
    got = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    for i, t, _ in rows:
        a, b = features(t)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(w[0] + shift + w[1] * a / scale + w[2] * b))), abs=1e-6), i


def test_toxicity_against_a_direct_computation(spark):
    """Words by a plain pattern, the test by plain sums, the likelihood by Newton steps with numeric slopes."""
    import re

    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        g = int(rng.choice(3, p=[0.6, 0.25, 0.15]))
        rows.append((i, " ".join(rng.choice(WORDS, 6)) + (" Vile" if rng.random() < 0.1 + 0.3 * g else "") + (" nasty, vile" if rng.random() < 0.05 + 0.35 * (g == 2) else ""), 2 * g))
    rows += [(900, "", 0), (901, None, 2), (902, "vile " * 20_000, 4)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, grade int")
    sets = [set(re.findall("[a-z0-9]+", (t or "").lower())) for _, t, _ in rows]
    y = np.array([g for *_, g in rows], float)
    var = ((y - y.mean()) ** 2).mean()
    z = {}
    for w in set().union(*sets):
        has = np.array([w in s for s in sets])
        if has.sum() >= 5:
            z[w] = (y - y.mean())[has].sum() / np.sqrt(has.sum() * (1 - has.sum() / (len(y) + 1)) * var)
    chosen = sorted(w for w in z if abs(z[w]) >= 5)
    assert {"vile", "nasty"} <= set(chosen)
    x, level = np.array([[w in s for w in chosen] for s in sets], float), (y / 2).astype(int)

    def loss(p):
        edge = np.concatenate([[-np.inf], p[len(chosen) :], [np.inf]])
        up = lambda t: 1 / (1 + np.exp(-(t - x @ p[: len(chosen)])))
        return -np.log(up(edge[level + 1]) - up(edge[level])).sum() + 0.05 * (p[: len(chosen)] ** 2).sum()

    p, eye = np.concatenate([np.zeros(len(chosen)), [0.5, 2.0]]), np.eye(len(chosen) + 2)
    for _ in range(30):
        h = 1e-4
        g = np.array([(loss(p + h * e) - loss(p - h * e)) / (2 * h) for e in eye])
        hess = np.array([[(loss(p + h * a + h * b) - loss(p + h * a - h * b) - loss(p - h * a + h * b) + loss(p - h * a - h * b)) / (4 * h * h) for a in eye] for b in eye])
        p = p - np.linalg.solve(hess, g)
    want = sum(2 / (1 + np.exp(-(x @ p[: len(chosen)] - t))) for t in p[len(chosen) :])
    got = {r.doc_id: r.severity for r in T.score(docs, T.fit(docs, labels, rounds=2_000)).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(want.tolist(), abs=1e-4)


def test_repeated_ids_do_not_enlarge_the_samples(spark):
    docs = spark.createDataFrame([(i % 3, f"{'good' if i % 3 else 'bad'} text {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id long, quality int")
    assert Q.score(docs, Q.fit(docs, labels)).count() == 300
    model = T.fit(docs, labels.select("doc_id", F.col("quality").alias("grade")))
    assert T.score(docs, model).agg(F.min("severity")).first()[0] == pytest.approx(2 / 3, abs=0.02)


def test_kept_rows_have_columns_of_any_name(spark, rows):
    docs = spark.createDataFrame([(1, "a text", "mine", 2)], "doc_id long, text string, scored string, _scored int")
    assert rows(Q.keep(docs, Q.Model(b"", b"", 5.0, 0.0, 0.0, 64.0))) == [(1, "a text", "mine", 2)]
