"""Quality classifier: zstandard dictionaries of good and of bad text, compared by compressed size.

Two dictionaries are trained on labelled text, one on good and one on bad documents.  A text is compressed with each,
whole, in pieces of ``PIECE`` bytes so that a long text cannot learn its own style and forget the dictionary.  The
main feature is (size with the bad one - size with the good one) / (bytes + shrink).  A logistic curve over it and over
bytes / (bytes + shrink), so that short texts keep a base rate of their own, is fitted on labelled documents that neither
dictionary saw; it turns the difference into a probability that the label is 1.  Lines that more than ``most_shared``
sampled documents share are boilerplate and stay out of both dictionaries; texts are scored with all their lines.

Nulls and repeats: null and empty texts get the score of feature 0, the curve's base rate; rows with null labels, or
with ids that no document has, teach nothing; several labels of one id count as their largest; of several texts of one
id the least one teaches; a repeated document is scored each time.  With fewer than two classes among the labels the
score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import crc_of_id, shared_dir, unit, unused, written

PIECE, LEVEL = 2048, 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    bias: float
    slope: float
    filled: float
    shrink: float

    def score(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = self.bias + self.slope * x + self.filled * n / (n + self.shrink)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def compressors(self):
        import zstandard

        return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (self.good, self.bad)]


def sizes(text: bytes, compressors) -> tuple[int, int]:
    """Compressed sizes of all pieces with the good and with the bad dictionary."""
    pieces = [text[k : k + PIECE] for k in range(0, len(text), PIECE)]
    return tuple(sum(len(c.compress(p)) for p in pieces) for c in compressors)


def _features(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    compressors = model.compressors()
    raw = [(t or "").encode() for t in texts.to_pylist()]
    n = np.array([len(t) for t in raw], float)
    pairs = np.array([sizes(t, compressors) for t in raw], float).reshape(len(raw), 2)
    return (pairs[:, 1] - pairs[:, 0]) / (n + model.shrink), n


def _logistic(x: np.ndarray, filled: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Maximum likelihood by Newton's method with a weak penalty; classes keep their shares."""
    w, scale = np.zeros(3), max(float(np.std(x)), 1e-9)
    design = np.stack([np.ones_like(x), x / scale, filled], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(3), design.T @ (p - y) + 1e-2 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w / [1, scale, 1]


def _own_lines(pieces: list[tuple[int, str]], most: int) -> list[tuple[int, str]]:
    """Pieces without the lines that more than ``most`` documents of the sample share."""
    seen: dict[str, set[int]] = {}
    for doc, piece in pieces:
        for line in piece.split("\n"):
            seen.setdefault(line, set()).add(doc)
    return [(doc, "\n".join(x for x in piece.split("\n") if len(seen[x]) <= most)) for doc, piece in pieces]


def _dictionary(texts: list[bytes], size: int) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts, k=64, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-size:]


@shipped
def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 2048, sample_pieces: int = 16_384, most_shared: int = 2, dictionary_bytes: int = 112_640, shrink: float = 64.0) -> Model:
    """Fit on a bounded sample: for each label, about ``sample_rows`` labelled ids for the dictionary and for the curve.

    A hash of the id draws them, all where there are fewer; another one says whether a row serves the dictionaries or the
    curve.  The dictionaries learn from the whole sampled texts, in pieces of ``PIECE`` characters; where those of a label
    are more than ``sample_pieces``, a hash draws about that many from anywhere in the texts.  The curve sees whole texts.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    labels = labels.withColumn("part", F.xxhash64("doc_id", F.lit(4)).bitwiseAND(1))
    share = {(r.y, r.part): min(1.0, sample_rows / r["count"]) for r in labels.groupBy("y", "part").count().collect()}
    shares = docs.sparkSession.createDataFrame([(*k, v) for k, v in share.items()], "y int, part long, share double")
    chosen = labels.join(F.broadcast(shares), ["y", "part"]).filter(unit(F.xxhash64("doc_id", F.lit(5))) < F.col("share")).drop("share")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"), F.first("part").alias("part"))
    sample = written(sample, shared_dir(docs.sparkSession, "quality-sample"))
    many = F.greatest(F.lit(1), F.ceil(F.length("text") / PIECE)).cast("int")
    number = {r.y: min(1.0, sample_pieces / r.n) for r in sample.filter("part = 0").groupBy("y").agg(F.sum(many).alias("n")).collect()}
    pieces = sample.filter("part = 0").select("y", "doc_id", "text", F.explode(F.sequence(F.lit(0), many - 1)).alias("place"))
    drawn = unit(F.xxhash64("doc_id", "place")) < F.when(F.col("y") == 1, number.get(1, 0.0)).otherwise(number.get(0, 0.0))
    seen = pieces.filter(drawn).select("y", "doc_id", "place", F.expr(f"substring(text, place * {PIECE} + 1, {PIECE})").alias("piece")).orderBy("doc_id", "place").collect()
    own = _own_lines([(r.doc_id, r.piece) for r in seen], most_shared)
    kind = {r.doc_id: r.y for r in seen}
    of = lambda y: [p.encode() for i, p in own if p and kind[i] == y]
    # labelled ids that have a text, each drawn one for as many as it stands for
    counts: dict[int, float] = {}
    for r in sample.groupBy("y", "part").count().collect():
        counts[r.y] = counts.get(r.y, 0) + r["count"] / share[r.y, r.part]
    if len(counts) < 2 or not of(0) or not of(1):
        rate = sum(y * n for y, n in counts.items()) / sum(counts.values()) if counts else 0.5
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return Model(b"", b"", float(np.log(rate / (1 - rate))), 0.0, 0.0, shrink)
    model = Model(_dictionary(of(1), dictionary_bytes), _dictionary(of(0), dictionary_bytes), 0.0, 0.0, 0.0, shrink)
    curve = sample.filter("part = 1").mapInArrow(_measured(model), "y int, x double, n double").collect()
    x, n, y = (np.array([float(r[c]) for r in curve]) for c in ("x", "n", "y"))
    if len(set(y)) < 2:
        return Model(model.good, model.bad, 0.0, 1.0 / max(1e-9, float(np.std(x)) if len(x) else 1.0), 0.0, shrink)
    # both labels are drawn equally often where there are enough; the weights restore their shares
    bias, slope, filled = _logistic(x, n / (n + shrink), y).tolist()
    ratio = y.mean() / (1 - y.mean())
    return Model(model.good, model.bad, bias + float(np.log(counts[1] / counts[0] / ratio)), slope, filled, shrink)


def _measured(model: Model):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import batches

        for batch in batches(it, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("y"), *map(pa.array, _features(batch.column("text"), model))], ["y", "x", "n"])

    return run


@shipped
def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; ``docs`` is read once and nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import batches

        model = shared.value
        for batch in batches(it, "text"):
            x, n = _features(batch.column("text"), model) if model.slope else np.zeros((2, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x, n))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


@shipped
def keep(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score ``threshold`` or more, with all their columns: one pass without a join."""
    shared, columns, scored = docs.sparkSession.sparkContext.broadcast(model), docs.columns, unused(docs, "scored")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import batches

        model = shared.value
        for batch in batches(it, scored):
            x, n = _features(batch.column(scored), model) if model.slope else np.zeros((2, batch.num_rows))
            yield batch.filter(pa.array(model.score(x, n) >= threshold)).select(columns)

    return docs.withColumn(scored, F.col("text").cast("string")).mapInArrow(run, docs.schema)


def held_out(doc_id) -> "F.Column":
    """Ids whose labels are kept for measuring: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(crc_of_id(doc_id), F.lit(4)) == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted): fitted on labels that aren't held out, applied to every whole text."""
    known = labels.filter(~held_out(F.col("doc_id")))
    return score(docs, fit(docs, known, **options)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
