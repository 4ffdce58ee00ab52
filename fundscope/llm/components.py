"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step reads the edges from files, points them to least neighbours by a grouped minimum and a join, and writes them
again; partitions first reduce their own edges to spanning forests.  Nodes with many edges meet their minimum in a bounded
broadcast, so no node's edges come to one task.  Nothing of the graph is collected.

Edges are pairs of integers that aren't null; an edge from a node to itself joins nothing, and a node with no other edge
is in no row.  Edges may repeat.  An empty table gives no rows.  Columns other than u and v are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import shared_dir, spread_join, written


def forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """Star edges (least member, member) of the components of the given edges."""
    ids, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = code[: len(u)], code[len(u) :], np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(ids)))
    return list(zip(ids[label[far]].tolist(), ids[far].tolist(), strict=True))


def _local(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as forests, reduced again whenever about a million are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        pairs = np.array(forest(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])), np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    for batch in it:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v")))
        n += batch.num_rows
        if n > 1 << 20:
            u, v = reduced()
            if len(u) > 1 << 19:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                held, n = [], 0
            else:
                held, n = [(u, v)], len(u)
    if held:
        u, v = reduced()
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _state(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


@shipped
def components(edges: DataFrame, alone: int = 1 << 19) -> DataFrame:
    """(rid, root) of every node with an edge; the root is the least node of its component.

    Once partitions have reduced their edges, ``alone`` of them or fewer (16 bytes each) are finished in one task.
    """
    spark = edges.sparkSession
    edges = written(edges.select("u", "v").filter("u <> v").mapInArrow(_local, "u long, v long").distinct(), shared_dir(spark, "edges"))
    stars = lambda e: e.select(F.col("v").alias("rid"), F.col("u").alias("root")).unionByName(e.select(F.col("u").alias("rid"), F.col("u").alias("root")).distinct())
    if edges.count() <= alone:
        return stars(written(edges.coalesce(1).mapInArrow(_local, "u long, v long"), shared_dir(spark, "edges")))
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        # large star: larger neighbours go to the least one, the node itself included
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        edges = written(spread_join(both, least, "u", "n", total=2 * now[0]).filter("v > u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct(), shared_dir(spark, "edges"))
        # small star: smaller neighbours and the node go to the least one
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        joined = spread_join(down, least, "u", "n", total=now[0])
        small = joined.select(F.col("m").alias("u"), F.col("v")).unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))
        edges = written(small.filter("u <> v").distinct(), shared_dir(spark, "edges"))
    return stars(edges)
