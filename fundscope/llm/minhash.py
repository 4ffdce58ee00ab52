"""Near duplicates by one-permutation minhash with optimal densification, banded buckets and star-shaped edges.

A document is the set of its distinct five-word shingles (all words as one, if there are fewer; words are runs of anything
but ASCII blanks, A to Z lower-cased).  Documents with equal sets are one member.  One hash of each shingle fills a
signature: its high half chooses one of ``BINS`` bins, and a bin keeps its least.  An empty bin takes the value of the
first full bin along a sequence of probes of its own (optimal densification), so bins of two members agree with the
probability of their Jaccard similarity however short they are.  ``BANDS`` bands of ``ROWS`` bins give a bucket each.

Pairs within a bucket are not candidates.  A member weighs the other members of all its buckets, and every bucket sends a
star: edges from its heaviest member to the rest.  The heaviest is the text that the others were copied from, or the
one nearest to it, and it is the same in most of a group's buckets; so edges grow with the members.  Edges are confirmed on the
full sets, in parts of ``part`` edges of one centre.  What the stars may have missed lies between members of one bucket
that are still in different components: buckets with such members are brought together with their sets, in blocks where
they are many, and compared there, signatures first.  That part is quadratic in the members of a cluster that the stars left
in several components, though its pairs never become rows.  A pair of just the wanted 0.85 shares no bucket with a
probability of 3e-6.

Nulls and repeats: null texts and texts without words have no shingles, form components of their own and link with
nothing, each other included; repeated rows are members like copies; a null doc_id takes part, a component is named by its
least id that isn't null, and rows without an id are kept only where the component has none.  An empty table gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import Cells, Places, groups, put_cells, shared_dir, spread_join, with_row_key, written
from .components import components
from .words import UNSPACED, Words, batches, grams, mix

SHINGLE, BANDS, ROWS = 5, 40, 8
BINS = BANDS * ROWS
#: Standard deviation of the share of agreeing bins at 0.85, for sets of any size (measured from 7 to 3,000 shingles).
DEVIATION = 0.025
_PROBES: list[np.ndarray] = []
_EDGES = "u long, v long"


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    return [np.unique(grams(w, SHINGLE)) for w in Words(texts, UNSPACED, True).rows()]


def _probe(attempt: int) -> np.ndarray:
    """Where each bin looks at its next attempt."""
    while len(_PROBES) <= attempt:
        h = mix(np.arange(BINS, dtype=np.uint64) + np.uint64((len(_PROBES) + 1) * 0x9E3779B97F4A7C15 % 2**64))
        _PROBES.append(((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64))
    return _PROBES[attempt]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of each bin's least shingle, a row per set; no set is empty, all are sorted."""
    sig, full = np.zeros((len(sets), BINS), np.uint16), np.zeros((len(sets), BINS), bool)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cell = owner * BINS + ((flat >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    sig.reshape(-1)[cell[first]] = flat[first].astype(np.uint16)
    full.reshape(-1)[cell[first]] = True
    row, empty = np.nonzero(~full)
    attempt = 0
    while len(row):
        source = _probe(attempt)[empty]
        found = full[row, source]
        sig[row[found], empty[found]] = sig[row[found], source[found]]
        row, empty, attempt = row[~found], empty[~found], attempt + 1
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    """A bucket for each band of each signature."""
    out = np.repeat(mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :], len(sig), 0)
    part = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    for k in range(0, ROWS, 4):
        packed = sum(part[:, :, k + i] << np.uint64(16 * i) for i in range(4))
        out = mix(out + packed * np.uint64(0x9E3779B97F4A7C15))
    return out


def _signed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, "text", 1 << 20):
        sets = shingle_sets(batch.column("text"))
        full = [k for k, s in enumerate(sets) if len(s)]
        sig = signatures([sets[k] for k in full]) if full else ()
        rid, n, signed = ([None] * len(sets) for _ in range(3))
        for k, s in zip(full, sig, strict=True):
            x = sets[k]
            rid[k], n[k], signed[k] = int((mix(x).sum(dtype=np.uint64) ^ np.uint64(len(x))).astype(np.int64)), len(x), s.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(rid, pa.int64()), pa.array(n, pa.int64()), pa.array(signed, pa.binary())], ["row", "doc_id", "rid", "n", "sig"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BINS)


def _buckets(folder: str):
    """(bucket, rid) of the rows that the side table names as members."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = Places(folder)
        for batch in it:
            if not batch.num_rows:
                continue
            for at, member in side.matches(batch.column("row").to_numpy(), "row"):
                for k in range(0, len(at), 4096):
                    found = bands(_matrix(batch.column("sig").take(pa.array(at[k : k + 4096])))).astype(np.int64)
                    rid = np.repeat(member.column("rid").to_numpy()[k : k + 4096], BANDS)
                    yield pa.RecordBatch.from_arrays([pa.array(found.reshape(-1)), pa.array(rid)], ["bucket", "rid"])

    return run


def _sets_of(folder: str):
    """Shingle sets of the rows that the side table names."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = Places(folder)
        for batch in batches(it, "text", 4 << 20):
            for at, member in side.matches(batch.column("row").to_numpy(), "row"):
                sets = pa.array([s.tobytes() for s in shingle_sets(batch.column("text").take(pa.array(at)))], pa.binary())
                for k in range(0, len(at), 256):
                    yield pa.RecordBatch.from_arrays([member.column("rid").slice(k, 256).combine_chunks(), sets.slice(k, 256)], ["rid", "shingles"])

    return run


def _linked(own: np.ndarray, others: list[np.ndarray], share: tuple[int, int]) -> np.ndarray:
    """Which of the other sets have an intersection with ``own`` of at least ``share`` of the union."""
    flat, sizes = np.concatenate(others), np.array([len(s) for s in others], np.int64)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    both = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return share[1] * both >= share[0] * (sizes + len(own) - both)


def _confirm(share: tuple[int, int]):
    """Links among the edges of one part of a centre; the row without ``v`` has the centre's own set."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (u, _), table in groups(it, ["u", "part"]):
            v = table.column("v").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            others = [k for k, x in enumerate(v) if x is not None]
            mine = [v[others[k]] for k in np.flatnonzero(_linked(sets[v.index(None)], [sets[k] for k in others], share))]
            yield pa.RecordBatch.from_arrays([pa.array([u] * len(mine), pa.int64()), pa.array(mine, pa.int64())], ["u", "v"])

    return run


def confirmed(edges: DataFrame, members: DataFrame, docs: DataFrame, share: tuple[int, int] = (85, 100), part: int = 256) -> DataFrame:
    """The rows of ``edges`` (u, v), distinct, whose full sets are similar enough: intersection and union as in ``share``.

    Only texts with an edge are cut into shingles again.  A centre's set meets the sets of ``part`` others at a time.
    """
    spark = docs.sparkSession
    edges = written(edges, shared_dir(spark, "candidates"))
    ends = edges.select(F.col("u").alias("rid")).unionByName(edges.select(F.col("v").alias("rid"))).distinct()
    folder = Places.put(members.select("rid", "row").join(ends, "rid").select("row", "rid"), "row", "compared")
    content = written(docs.select("row", "text").mapInArrow(_sets_of(folder), "rid long, shingles binary"), shared_dir(spark, "shingles"), compression="zstd")
    degree = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    placed = written(spread_join(edges, degree, "u", "n").withColumn("part", F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / part))).select("u", "part", "v"), shared_dir(spark, "parts"))
    others = placed.join(content.withColumnRenamed("rid", "v"), "v").select("u", "part", "v", "shingles")
    own = placed.select("u", "part").distinct().join(content.withColumnRenamed("rid", "u"), "u").select("u", "part", F.lit(None).cast("long").alias("v"), "shingles")
    return written(others.unionByName(own).repartition("u", "part").sortWithinPartitions("u", "part").mapInArrow(_confirm(share), _EDGES), shared_dir(spark, "links"))


def star_edges(met: DataFrame) -> DataFrame:
    """(u, v): the heaviest member of each bucket of ``met`` (bucket, rid, n) with each other one, once."""
    weights = met.groupBy("rid").agg(F.sum(F.col("n") - 1).alias("weight"))
    weighted = met.join(weights, "rid")
    centres = weighted.groupBy("bucket").agg(F.max(F.struct("weight", "rid"))["rid"].alias("u"), F.count(F.lit(1)).alias("n"))
    return spread_join(met.select("bucket", "rid"), centres, "bucket", "n").filter("u <> rid").select("u", F.col("rid").alias("v")).distinct()


class _Block:
    """Members of a cluster with their sets."""

    def __init__(self, table: pa.Table):
        self.rid, self.root = table.column("rid").to_numpy(), table.column("root").to_numpy().copy()
        self.sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        self.sig = signatures(self.sets)
        self.bands = bands(self.sig)


def _missed(a: _Block, b: _Block, least: float, share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Links between members of two blocks, or of one, that are in different components so far.

    Those that share a bucket and whose signatures agree are compared on their sets; a link joins the components, so what
    comes out is never more than the components there were.
    """
    u, v = [], []
    for k in range(len(a.rid)):
        others = np.flatnonzero(b.root != a.root[k])
        if a is b:
            others = others[others > k]
        if len(others):
            others = others[(b.sig[others] == a.sig[k]).mean(axis=1) >= least]
        if len(others):
            others = others[(b.bands[others] == a.bands[k]).any(axis=1)]
        if len(others):
            for j in others[_linked(a.sets[k], [b.sets[x] for x in others], share)].tolist():
                old, new = b.root[j], a.root[k]
                if old != new:
                    u.append(int(a.rid[k]))
                    v.append(int(b.rid[j]))
                    for block in (a, b):
                        block.root[block.root == old] = new
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _within(least: float, share: tuple[int, int]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in groups(it, ["cluster"]):
            block = _Block(table)
            yield from _missed(block, block, least, share)

    return run


def _between(least: float, share: tuple[int, int], folder: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(folder, 1)
        for batch in it:
            for cluster, left, right in zip(*(batch.column(c).to_pylist() for c in ("cluster", "left", "right")), strict=True):
                tables = [cells[cluster, k] for k in dict.fromkeys((left, right))]
                if all(t is not None for t in tables):
                    blocks = [_Block(t) for t in tables]
                    yield from _missed(blocks[0], blocks[-1], least, share)

    return run


def left_over(met: DataFrame, members: DataFrame, docs: DataFrame, links: DataFrame, least: float, share: tuple[int, int], block: int = 1024, block_shingles: int = 1 << 20) -> DataFrame:
    """(u, v): links of one bucket between different components of ``links``.

    Only buckets that hold members of several components are looked at.  Those that share members form a cluster; its
    members' sets come together once, in blocks that tasks read in pairs from the shared store where they are many, and are
    compared there.  Pairs never become rows.
    """
    spark = met.sparkSession
    roots = written(components(links), shared_dir(spark, "roots"))
    labelled = met.join(roots, "rid", "left").select("bucket", "rid", F.coalesce("root", "rid").alias("root"))
    split = labelled.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.min("rid").alias("first"), F.count(F.lit(1)).alias("n")).filter("a <> b").select("bucket", "first", "n")
    split = written(split, shared_dir(spark, "unsettled"))
    rows = written(spread_join(labelled, split, "bucket", "n", merge=True).select("first", "rid", "root"), shared_dir(spark, "split"))
    clusters = components(rows.select(F.col("first").alias("u"), F.col("rid").alias("v")).distinct()).withColumnRenamed("root", "cluster")
    known = rows.select("rid", "root").distinct().join(clusters, "rid").join(members.select("rid", "row", "n"), "rid")
    known = written(known, shared_dir(spark, "clustered"))
    size = known.groupBy("cluster").agg(F.count(F.lit(1)).alias("many"), F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / block_shingles)).alias("blocks"))
    size = written(size, shared_dir(spark, "cluster-sizes"))
    placed = spread_join(known, size, "cluster", "many").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")))
    folder = Places.put(placed.select("row", "rid"), "row", "compared")
    content = written(docs.select("row", "text").mapInArrow(_sets_of(folder), "rid long, shingles binary"), shared_dir(spark, "shingles"), compression="zstd")
    content = placed.select("cluster", "blocks", "block", "rid", "root").join(content, "rid")
    found = content.filter("blocks = 1").repartition("cluster").sortWithinPartitions("cluster").mapInArrow(_within(least, share), _EDGES)
    large = size.filter("blocks > 1")
    if not large.isEmpty():
        folder = shared_dir(spark, "blocks")
        put_cells(content.filter("blocks > 1").select("cluster", "block", "rid", "root", "shingles"), ["cluster", "block"], ["rid"], folder)
        upto = lambda a, c: F.explode(F.sequence(a, c - 1))
        pairs = large.select("cluster", "blocks", upto(F.lit(0).cast("long"), F.col("blocks")).alias("left")).select("cluster", "left", upto(F.col("left"), F.col("blocks")).alias("right"))
        tasks = max(1, -(-pairs.count() // 4))
        found = found.unionByName(pairs.repartitionByRange(tasks, "cluster", "left", "right").sortWithinPartitions("cluster", "left", "right").mapInArrow(_between(least, share, folder), _EDGES))
    return written(found, shared_dir(spark, "links"))


@shipped
def deduplicated(docs: DataFrame, *, share: tuple[int, int] = (85, 100), deviations: float = 5.0, row: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Two documents are linked if their sets' intersection is at least ``share`` of their union; components are those of the
    links.  ``kept`` marks the rows whose id names the component.  ``row`` numbers the rows of ``docs``; without it they
    are numbered by their places in the files.
    """
    spark, similarity = docs.sparkSession, share[0] / share[1]
    docs, row = (docs, row) if row else (with_row_key(docs.select("doc_id", "text")), "_row")
    docs = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = written(docs.mapInArrow(_signed, "row long, doc_id long, rid long, n long, sig binary"), shared_dir(spark, "sets"))
    members = sets.filter("rid is not null").groupBy("rid").agg(F.min("row").alias("row"), F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))
    members = written(members, shared_dir(spark, "members"))
    folder = Places.put(members.select("row", "rid"), "row", "first-rows")
    buckets = written(sets.select("row", "sig").mapInArrow(_buckets(folder), "bucket long, rid long"), shared_dir(spark, "buckets"))
    counts = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), shared_dir(spark, "counts"))
    met = written(spread_join(buckets, counts, "bucket", "n", merge=True), shared_dir(spark, "met"))
    links = confirmed(star_edges(met), members, docs, share)
    least = similarity - deviations * DEVIATION
    links = links.unionByName(left_over(met, members, docs, links, least, share))

    slim = members.select("rid", "rep", "copies")
    classes = written(components(links).join(slim.select("rid", "rep"), "rid"), shared_dir(spark, "classes"))
    names = written(classes.groupBy("root").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("many")), shared_dir(spark, "names"))
    classes = spread_join(classes, names, "root", "many").select("rid", "component_id")
    known = written(slim.join(classes, "rid", "left").select("rid", "copies", F.coalesce("component_id", "rep").alias("component_id")), shared_dir(spark, "known"))
    some = spread_join(sets.filter("rid is not null").select("doc_id", "rid", "n"), known, "rid", "copies").select("doc_id", "n", "component_id")
    none = sets.filter("rid is null").select("doc_id", F.lit(0).cast("long").alias("n"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
