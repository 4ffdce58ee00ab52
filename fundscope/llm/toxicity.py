"""Toxicity: cumulative-link ordinal regression on sparse text features.

Grades are ordered integers 0, 1, ...; P(grade > g) = sigmoid(w . x - threshold[g]), with one weight vector w for all
thresholds.  Features are the presence of words (hashed), chosen by a score test of their association with the grade.
The result is the expected severity, the sum of grade * P(grade).  On the test tables labels are 0 and 1, which leaves
one threshold.

Nulls and repeats: null and empty texts have no features and get the severity of the thresholds alone; rows with null or
negative grades, or with ids that no document has, teach nothing; several grades of one id count as their largest; of
several texts of one id the least one teaches; a repeated document is scored each time.  Without labels every severity is
0; with one grade only it is that grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import shared_dir, unit, written
from .words import Words, batches


@dataclass(frozen=True)
class Model:
    grades: np.ndarray
    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, logits: np.ndarray) -> np.ndarray:
        """P(grade > g) for all but the last grade, a row per document."""
        return 1 / (1 + np.exp(-np.clip(logits[:, None] - self.thresholds[None, :], -500, 500)))

    def severity(self, logits: np.ndarray) -> np.ndarray:
        if not len(self.thresholds):
            return np.full(len(logits), float(self.grades[0]) if len(self.grades) else 0.0)
        return self.grades[0] + self.above(logits) @ np.diff(self.grades).astype(float)

    def logits(self, words: Words) -> np.ndarray:
        out = np.zeros(len(words.offsets) - 1)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words.hashes), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == words.hashes)
            doc = np.searchsorted(words.offsets, hit, "right") - 1
            pairs = np.unique(doc * len(self.words) + at[hit])
            np.add.at(out, pairs // len(self.words), self.weights[pairs % len(self.words)])
        return out


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, n: int, width: int, level: np.ndarray, levels: int, penalty: float = 1.0, rounds: int = 400, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the penalised likelihood; (rows, cols) are the ones of a 0/1 matrix.

    A row of weight 3 counts as three equal rows; without ``weight`` each counts once.  Thresholds are a first one plus
    exponentials, so they stay in order; a row meets its own two only, so a round costs the same for any number of levels.
    """
    weight = np.ones(n) if weight is None else weight
    above = 1 - np.cumsum(np.bincount(level, weight, levels))[:-1] / weight.sum()
    first = np.log((1 - above.clip(1e-6, 1 - 1e-6)) / above.clip(1e-6, 1 - 1e-6))
    start = np.concatenate([np.zeros(width), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    low, high = level > 0, level < levels - 1
    under = lambda t, z: 1 / (1 + np.exp(-np.clip(t - z, -500, 500)))
    steps = lambda p: np.exp(np.clip(p[width + 1 :], -50, 50))
    edges = lambda p: p[width] + np.concatenate([[0.0], np.cumsum(steps(p))])

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, t = p[:width], edges(p)
        z = np.bincount(rows, w[cols], n) if len(rows) else np.zeros(n)
        upper, lower = np.ones(n), np.zeros(n)  # P(level <= own), P(level < own)
        upper[high], lower[low] = under(t[level[high]], z[high]), under(t[level[low] - 1], z[low])
        p_own = np.maximum(upper - lower, 1e-300)
        du, dl = weight * upper * (1 - upper) / p_own, weight * lower * (1 - lower) / p_own
        gt = np.bincount(level[low] - 1, dl[low], levels - 1) - np.bincount(level[high], du[high], levels - 1)
        gw = np.bincount(cols, (du - dl)[rows], width) + penalty * w
        tail = np.cumsum(gt[::-1])[::-1]
        return float(-(weight * np.log(p_own)).sum() + penalty / 2 * (w @ w)), np.concatenate([gw, tail[:1], tail[1:] * steps(p)])

    best = _descend(loss, start, rounds, 1e-9 * weight.sum())
    return best[:width], edges(best)


def _descend(loss, p: np.ndarray, rounds: int, enough: float, held: int = 12) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps, until no slope exceeds ``enough``."""
    value, slope = loss(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(slope).max() <= enough:
            break
        way, parts = -slope, []
        for s, y in reversed(past):
            parts.append((s @ way) / (s @ y))
            way = way - parts[-1] * y
        if past:
            s, y = past[-1]
            way = way * (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(parts), strict=True):
            way = way + (a - (y @ way) / (s @ y)) * s
        size, gain = 1.0 if past else 1.0 / max(1.0, np.abs(slope).max()), slope @ way
        while size > 1e-12:
            new_value, new_slope = loss(p + size * way)
            if new_value <= value + 1e-4 * size * gain:
                break
            size /= 2
        else:
            if not past:
                break
            past = []
            continue
        s, y = size * way, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            past = [*past, (s, y)][-held:]
        p, value, slope = p + s, new_value, new_slope
    return p


def _present(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word hashes of each labelled text."""
    for batch in batches(it, "text", 2 << 20):
        sets = [np.unique(w).astype(np.int64) for w in Words(batch.column("text")).rows()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), batch.column("weight"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "grade", "weight", "words"])


@shipped
def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 32_768, features: int = 4_096, least_docs: int = 5, least_z: float = 5.0, penalty: float = 0.1, rounds: int = 400) -> Model:
    """Fit on about ``sample_rows`` labelled ids, dealt evenly to the grades, drawn by a hash; ``labels``: doc_id, grade.

    Every grade has a row at least, whatever their number, and all of its rows where they are few.  Rows of a grade that is drawn in part weigh as many ids as
    each stands for, in the choice of words and in the fit, so the grades keep their true shares at every size of the
    table.  ``features`` is the number of words that the model may hold.
    """
    spark = docs.sparkSession
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade")).filter("doc_id is not null and grade >= 0").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    total = {r.grade: r["count"] for r in labels.groupBy("grade").count().collect()}
    grades = np.array(sorted(total))
    if len(grades) < 2:
        return Model(grades, np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    each = max(1, sample_rows // len(grades))
    weights = spark.createDataFrame([(g, max(1.0, total[g] / each)) for g in grades.tolist()], "grade int, weight double")
    # the least hash of a grade is drawn in any case
    drawn = (unit(F.col("h")) * F.col("weight") < 1) | (F.col("h") == F.col("least"))
    hashed = labels.withColumn("h", F.xxhash64("doc_id", F.lit(8)))
    least = hashed.groupBy("grade").agg(F.min("h").alias("least"))
    chosen = hashed.join(F.broadcast(weights.join(least, "grade")), "grade").filter(drawn).select("doc_id", "grade", "weight")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    one = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("grade").alias("grade"), F.first("weight").alias("weight"))
    sample = written(one.mapInArrow(_present, "doc_id long, grade int, weight double, words array<long>"), shared_dir(spark, "toxic-sample"))
    grades = np.array(sorted(r.grade for r in sample.select("grade").distinct().collect()) or grades[:1].tolist())
    n, mean = sample.agg(F.count(F.lit(1)), F.sum(F.col("weight") * F.col("grade")) / F.sum("weight")).first()
    var = n and sample.agg(F.avg((F.col("weight") * (F.col("grade") - mean)) ** 2)).first()[0]
    if not n or not var:
        return Model(grades[:1], np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    excess = F.sum(F.col("weight") * (F.col("grade") - mean))
    tested = sample.select("grade", "weight", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"), excess.alias("excess")).filter(F.col("df") >= least_docs)
    z = F.col("excess") / F.sqrt(F.col("df") * (1 - F.col("df") / (n + 1.0)) * var)
    best = [r.word for r in tested.withColumn("z", z).filter(F.abs("z") >= least_z).orderBy(F.desc(F.abs("z")), "word").limit(features).select("word").collect()]
    words = np.sort(np.array(best, np.int64).astype(np.uint64))
    rows, cols, level, weight = [], [], [], []
    for k, r in enumerate(sample.mapInArrow(_kept(words), "doc_id long, grade int, weight double, places array<int>").orderBy("doc_id", "grade").collect()):
        rows += [k] * len(r.places)
        cols += r.places
        level.append(int(np.searchsorted(grades, r.grade)))
        weight.append(r.weight)
    w, t = fit_ordinal(np.array(rows, np.int64), np.array(cols, np.int64), len(level), len(words), np.array(level), len(grades), penalty, rounds, np.array(weight))
    return Model(grades, words, w, t)


def _kept(words: np.ndarray):
    """Places of each row's words among the model's."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            lists = batch.column("words")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            at = np.minimum(np.searchsorted(words, flat), max(0, len(words) - 1))
            hit = words[at] == flat if len(words) else np.zeros(len(flat), bool)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            found = np.concatenate([[0], np.cumsum(hit)])[ends].astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(found), pa.array(at[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), batch.column("weight"), places], ["doc_id", "grade", "weight", "places"])

    return run


@shipped
def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade): expected severity, and the likeliest grade; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches(it, "text", 2 << 20):
            z = model.logits(Words(batch.column("text")))
            severity = model.severity(z)
            if len(model.thresholds):
                edges = np.concatenate([np.ones((len(z), 1)), model.above(z), np.zeros((len(z), 1))], 1)
                grade = model.grades[np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)]
            else:
                grade = np.round(severity)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(severity), pa.array(grade.astype(np.int32))], ["doc_id", "severity", "grade"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, severity double, grade int")
