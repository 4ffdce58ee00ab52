"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is then sent down it to a leaf.  A search keeps a priority queue
of tree nodes by the inner product of the query with their centres, opens the best one, and visits leaves in that order.
How many leaves it visits is calibrated: for sampled queries the exact neighbours are found by brute force over all
vectors, and visits widen until the wanted share of them lies in visited leaves.  Leaves are scored exactly, in double
precision: neighbouring leaves form parts, so that a query goes once to a part with the leaves that it visits there, and
a leaf with much of the table is cut into blocks for many tasks.

Nulls and repeats: rows with a null id, or a vector that is null, empty, zero, of another length than most, or holds null
or non-finite components, take no part.  An id counts once: of several vectors with one id the least, component by
component, stands for it.  Of equal vectors only the ``k + 1`` smallest ids can be
among a query's ``k`` nearest, so no more are kept as candidates; all are queries.  With fewer than ``k`` candidates all
are returned.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import groups, shared_dir, written

_PAIRS = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes in preorder of their making: children[n] is empty for leaves, whose number is leaf[n]."""

    centres: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))
    children: list[list[int]] = field(default_factory=lambda: [[]])
    leaf: list[int] = field(default_factory=lambda: [0])

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: at every node, the child with the nearest centre."""
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
            elif len(rows):
                c = self.centres[kids]
                near = np.argmin((c * c).sum(1) - 2 * x[rows] @ c.T, axis=1)
                todo += [(kid, rows[near == k]) for k, kid in enumerate(kids)]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            node = heapq.heappop(queue)[1]
            kids = self.children[node]
            if not kids:
                out.append(self.leaf[node])
            for kid, s in zip(kids, (self.centres[kids] @ q).tolist() if kids else (), strict=True):
                heapq.heappush(queue, (-s, kid))
        return out


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def fit_tree(sample: np.ndarray, leaf_rows: int, branching: int = 16, seed: int = 5) -> Tree:
    rng = np.random.default_rng(seed)
    centres, children, leaf, todo = [np.zeros(sample.shape[1])], [[]], [-1], [(0, sample)]
    while todo:
        node, x = todo.pop()
        if len(x) <= leaf_rows or len(distinct := np.unique(x, axis=0)) < 2:
            continue
        c = _kmeans(distinct, min(branching, len(distinct)), rng)
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        full = [k for k in range(len(c)) if (near == k).any()]
        if len(full) < 2:
            continue
        for k in full:
            children[node].append(len(centres))
            centres.append(x[near == k].mean(axis=0))
            children.append([])
            leaf.append(-1)
            todo.append((len(centres) - 1, x[near == k]))
    ends = [k for k, kids in enumerate(children) if not kids]
    for n, k in enumerate(ends):
        leaf[k] = n
    return Tree(np.array(centres), children, leaf)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, one addition order for any blocking."""
    return np.einsum("ij,ij->i", queries, vectors)


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of q, rows of x, scores): each query's best ``k`` here, ties to smaller ids, itself left out.

    ``allowed``: which rows of x each query may see.
    """
    rough = q @ x.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    if allowed is not None:
        rough[~allowed] = -np.inf
    place = max(0, len(ids) - k)
    cut = np.partition(rough, place, axis=1)[:, place]
    # all that may tie with the last one once added up in one order
    cut = np.where(np.isfinite(cut), cut - 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(cut), cut, 0))), -1.7e308)
    r, c = np.nonzero(rough >= cut[:, None])
    s = scores(q[r], x[c])
    order = np.lexsort((ids[c], -s, r))
    r, c, s = r[order], c[order], s[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    return r[rank < k], c[rank < k], s[rank < k]


def _usable(table: DataFrame) -> DataFrame:
    e = F.col("embedding")
    table = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(e.isNotNull() & F.col("vec_id").isNotNull())
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    table = table.filter((F.size(e) > 0) & ~F.exists(e, bad) & F.exists(e, lambda x: x != 0))
    width = table.groupBy(F.size(e).alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return table.filter(F.size(e) == (width.w if width else 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


@shipped
def nearest(vectors: DataFrame, is_query, *, k: int = 20, recall: float = 0.95, sample_rows: int = 20_000, leaf_rows: int = 400, calibration_queries: int = 256, block_rows: int = 4096, block_queries: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows (vec_id, embedding) where ``is_query`` holds, the ``k`` nearest found."""
    spark = vectors.sparkSession
    rows = written(_usable(vectors), shared_dir(spark, "vectors"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("embedding").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(np.array([r.embedding for r in sample]), leaf_rows)
    shared = spark.sparkContext.broadcast(tree)

    def send_down(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(shared.value.assign(_vectors(b.column("embedding"))))], ["vec_id", "embedding", "leaf"])

    few = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id")) <= k + 1
    points = rows.withColumn("few", few).filter("few").select("vec_id", "embedding")
    points = written(points.mapInArrow(send_down, "vec_id long, embedding array<double>, leaf int"), shared_dir(spark, "points"))
    queries = rows.filter(is_query)
    visits = _calibrate(points, queries, shared, k, recall, calibration_queries)

    # a row per leaf of the tree, which the sample bounds
    sizes = {r.leaf: r["count"] for r in points.groupBy("leaf").count().collect()}
    group_of, blocks = _packed(tree.leaves, sizes, block_rows)

    def plan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            plans = []
            for q in _vectors(b.column("embedding")):
                own: dict[int, list[int]] = {}
                for leaf in _enough(shared.value, q, visits, sizes, k):
                    own.setdefault(group_of[leaf], []).append(leaf)
                plans.append([{"part": g, "leaves": v} for g, v in own.items()])
            kind = pa.list_(pa.struct([("part", pa.int32()), ("leaves", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(plans, kind)], ["vec_id", "embedding", "parts"])

    planned = written(queries.mapInArrow(plan, "vec_id long, embedding array<double>, parts array<struct<part:int,leaves:array<int>>>"), shared_dir(spark, "visits"))
    asked = planned.select(F.explode("parts.part").alias("part")).groupBy("part").count().collect()
    table = spark.createDataFrame([(r.part, blocks[r.part], -(-r["count"] // block_queries)) for r in asked], "part int, blocks int, turns int")
    where = spark.createDataFrame(list(group_of.items()), "leaf int, part int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    salt = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
    left = points.join(F.broadcast(where.join(table, "part")), "leaf").select("part", salt("blocks").alias("block"), upto("turns").alias("turn"), F.lit(0).alias("kind"), "vec_id", "embedding", F.array("leaf").alias("leaves"))
    right = planned.select("vec_id", "embedding", F.explode("parts").alias("p")).select("vec_id", "embedding", "p.part", "p.leaves").join(F.broadcast(table), "part")
    right = right.select("part", salt("turns").alias("turn"), upto("blocks").alias("block"), F.lit(1).alias("kind"), "vec_id", "embedding", "leaves")
    both = left.unionByName(right).repartition("part", "block", "turn").sortWithinPartitions("part", "block", "turn")
    most = tree.leaves

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in groups(it, ["part", "block", "turn"]):
            kind, ids, x = t.column("kind").to_numpy(), t.column("vec_id").to_numpy(), _vectors(t.column("embedding"))
            leaves = t.column("leaves").combine_chunks()
            flat, row = leaves.flatten().to_numpy(), np.repeat(np.arange(len(leaves)), leaves.value_lengths().to_numpy())
            seen = np.zeros((len(leaves), most), bool)
            seen[row, flat] = True
            p, q = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
            if len(p) and len(q):
                leaf = np.argmax(seen[p], axis=1)
                for k0 in range(0, len(q), 256):
                    part = q[k0 : k0 + 256]
                    r, c, s = _best(ids[part], x[part], ids[p], x[p], k, seen[part][:, leaf])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part][r]), pa.array(ids[p][c]), pa.array(s)], ["query_id", "vec_id", "score"])

    found = both.mapInArrow(search, _PAIRS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _enough(tree: Tree, q: np.ndarray, visits: int, sizes: dict[int, int], k: int) -> list[int]:
    """The leaves that ``q`` visits: the calibrated number, and on along its queue until they hold ``k`` points besides it."""
    most = visits
    while True:
        leaves = tree.visits(q, most)
        if most >= tree.leaves or sum(sizes.get(x, 0) for x in leaves) > k:
            return leaves
        most = min(tree.leaves, 2 * most)


def _packed(leaves: int, sizes: dict[int, int], block_rows: int) -> tuple[dict[int, int], dict[int, int]]:
    """(part of each leaf, blocks of each part): neighbouring leaves share a part, a larger leaf has blocks of its own."""
    part_of, rows = {}, []
    for leaf in range(leaves):
        n = sizes.get(leaf, 0)
        if not rows or (rows[-1] and rows[-1] + n > block_rows):
            rows.append(0)
        part_of[leaf] = len(rows) - 1
        rows[-1] += n
    return part_of, {g: max(1, -(-n // block_rows)) for g, n in enumerate(rows)}


def _calibrate(points: DataFrame, queries: DataFrame, shared, k: int, recall: float, most: int) -> int:
    """Leaves to visit: the fewest with which ``recall`` of sampled queries' exact neighbours are reached."""
    sampled = queries.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(most).collect()
    if not sampled:
        return 1
    q_ids, q = np.array([r.vec_id for r in sampled]), np.array([r.embedding for r in sampled])

    def brute(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[float, int, int]]] = {int(i): [] for i in q_ids}
        for b in it:
            if b.num_rows:
                ids, leaf = b.column("vec_id").to_numpy(), b.column("leaf").to_numpy()
                r, c, s = _best(q_ids, q, ids, _vectors(b.column("embedding")), k)
                for i, found in zip(q_ids[r].tolist(), zip((-s).tolist(), ids[c].tolist(), leaf[c].tolist(), strict=True), strict=True):
                    kept[i].append(found)
                for best in kept.values():
                    best.sort()
                    del best[k:]
        flat = [(i, v, -s, leaf) for i, best in kept.items() for s, v, leaf in best]
        cols = list(zip(*flat, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int32()), strict=True)], ["query_id", "vec_id", "score", "leaf"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    truth = points.mapInArrow(brute, _PAIRS + ", leaf int").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).select("query_id", "leaf").collect()
    places = {int(i): {leaf: n for n, leaf in enumerate(shared.value.visits(v, shared.value.leaves))} for i, v in zip(q_ids, q, strict=True)}
    needed = np.sort([places[r.query_id][r.leaf] for r in truth])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1 if len(needed) else 1
