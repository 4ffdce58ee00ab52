"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents stand in a permuted order (md5 of seed, id and text); their words form a stream that repeats up
to ``cap`` times and is cut into blocks of ``block_words``, each with the documents that begin in it.  A source's target
fixes its quota of blocks.  The tree starts with the quotas of all sources and halves them again and again: a node's left
child gets half of its blocks, how many of each source by a multivariate hypergeometric draw seeded by the node.  A leaf
is an output shard with exact quotas.  It takes the next so many blocks of each source in an order permuted by a seeded
Feistel network of the source's own, so its blocks are disjoint from all other shards', and a hash shuffles the documents
of the shard.  Documents stay whole but for the one in which a source's target ends.

Nulls and repeats: a null text has size 0 and takes nothing; a null source is a source of its own, after all others; a
null doc_id is an id like any other.  Rows with one id and different texts have places of their own; rows equal in both
are interchangeable and follow each other.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..shipping import shipped
from .common import Places, shared_dir, unused, with_row_key, written
from .words import mix as hashed
from .words import release

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_targets(sources: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size, weight, target) of rows (source, source_size), one per source.

    Weights are 1, 2, 3 and again, by code point of the source, null last.  Resharing what exceeds ``cap`` times a size
    until nothing does ends at min(cap * size, level * weight) with one level for all: sources are capped in order of
    size / weight, and the level is what remains per weight after the longest capped prefix.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, every = by_room.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    ranked = ranked.withColumn("level_here", level)
    open_ = F.when(cap * F.col("source_size") >= F.col("level_here") * F.col("weight"), F.col("level_here"))
    # the first source that isn't capped fixes the level
    first = F.row_number().over(by_room)
    ranked = ranked.withColumn("at", F.when(open_.isNotNull(), first)).withColumn("level", F.min_by("level_here", "at").over(every))
    target = F.least(cap * F.col("source_size"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def permuted(docs: DataFrame, seed: str, rows: int, cell_rows: int = 1024, most_hot: int = 50_000) -> DataFrame:
    """``docs`` (row, doc_id, source, size, content) with ``h``, and ``begin``: words of the source before the document.

    The order is that of ``h``.  Two levels of cells, prefixes of it, keep every window small: a source with a third of
    all rows spreads over as many cells as its share, and no window sees more than about the square root of the number of
    cells.  Equal rows share one ``h``.  Those with 1 / ``most_hot`` of all rows or more, at most ``most_hot`` such ``h``,
    get cells of their own, cut by a hash of the row: as they are interchangeable, any order among them is right.
    """
    fine = max(0, int(np.ceil(np.log2(max(1, rows / cell_rows)))))
    digits = max(1, -(-fine // 4))
    coarse = digits // 2
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.withColumn("h", F.md5(F.concat(F.lit(seed), shown("doc_id"), F.lit(":"), shown("content")).cast("binary")))
    hot = docs.groupBy("h").count().filter(F.col("count") >= max(4 * cell_rows, -(-rows // most_hot)))
    hot = hot.select("h", F.ceil(F.col("count") / cell_rows).alias("cells"))
    docs = docs.join(F.broadcast(hot), "h", "left")
    own = F.concat("h", F.lpad(F.hex(F.pmod(F.xxhash64("row"), F.col("cells"))), 16, "0"))
    docs = docs.withColumns({"c1": F.substring("h", 1, coarse), "c2": F.coalesce(own, F.substring("h", 1, digits))}).drop("cells")
    cells = docs.groupBy("source", "c1", "c2").agg(F.sum("size").alias("n"))
    tops = cells.groupBy("source", "c1").agg(F.sum("n").alias("n"))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    prior = lambda col, w: F.coalesce(F.sum(col).over(w), F.lit(0))
    tops = tops.select("source", "c1", prior("n", before("source", "c1")).alias("b1"))
    cells = cells.withColumn("b2", prior("n", before("source", "c1", "c2")))
    cells = cells.join(tops, cells["source"].eqNullSafe(tops["source"]) & (cells["c1"] == tops["c1"])).select(cells["source"].alias("s"), cells["c2"].alias("c"), (F.col("b1") + F.col("b2")).alias("base"))
    inside = Window.partitionBy("source", "c2").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("here", prior("size", inside))
    return docs.join(cells, docs["source"].eqNullSafe(cells["s"]) & (docs["c2"] == cells["c"])).withColumn("begin", F.col("base") + F.col("here")).drop("s", "c", "c1", "c2", "base", "here")


def splitting_tree(quotas: np.ndarray, depth: int, seed: int) -> np.ndarray:
    """Quotas of the 2**depth leaves, a row each; columns add up to ``quotas`` and rows differ by one block at most."""
    level = quotas.astype(np.int64)[None, :]
    for d in range(depth):
        split = []
        for k, row in enumerate(level):
            rng = np.random.default_rng([seed, d, k])
            total = int(row.sum())
            left = rng.multivariate_hypergeometric(row, total // 2, method="marginals") if total < 10**9 else _by_halves(row, rng)
            split += [left, row - left]
        level = np.array(split)
    return level


def _by_halves(row: np.ndarray, rng) -> np.ndarray:
    """Beyond numpy's limit: each source is drawn from as many blocks as its limit allows, in turns."""
    left, rest = np.zeros_like(row), row.copy()
    while rest.any():
        part = np.minimum(rest, max(1, 10**8 // len(row)))
        left += rng.multivariate_hypergeometric(part, int(part.sum()) // 2, method="marginals")
        rest = rest - part
    return left


@shipped
def mix(docs: DataFrame, *, cap: int = 3, block_words: int = 4096, shard_words: int = 1 << 20, most_cells: int = 1 << 22, most_sources: int = 200_000, seed: int = 6, row: str | None = None) -> DataFrame:
    """Pieces of the mix: (row, shard, place, doc_id, source, size, source_size, target, block, words, turn).

    A piece is one taking of a document: ``turn`` counts the passes over the source (0 to cap - 1), ``words`` is its size
    but where the target ends within it, ``block`` is its block of the source's stream and ``place`` orders the shard.
    Words are those of ``WORD``.  Sizes are stored once: the text is read once for any number of passes.  ``row`` is the
    column that numbers the rows of ``docs``; without it they are numbered by their places in the files.  Documents that
    no piece takes come as a row with null shard and 0 words.  There are as many shards as ``shard_words`` asks, rounded
    down to a power of two, as long as shards times sources stay below ``most_cells``.  The plan (targets, quotas and
    shards of each source) is broadcast, which ``most_cells`` bounds; more than ``most_sources`` sources are refused.
    """
    spark = docs.sparkSession
    docs, row = (docs, row) if row else (with_row_key(docs.select("doc_id", "source", "text")), "_row")
    text = F.col("text").cast("string")
    sized = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("content"))
    sized = written(sized, shared_dir(spark, "sizes"))
    summed = written(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), shared_dir(spark, "sources"))
    n_sources, words, rows = summed.agg(F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    if n_sources > most_sources:
        raise ValueError(f"{n_sources} sources; the plan holds {most_sources} at most")
    table = with_targets(summed.select("source", "source_size"), cap).orderBy(F.col("source").asc_nulls_last()).collect()
    shards = max(1, min(most_cells // max(1, n_sources), -(-words // shard_words)))
    depth = int(np.log2(shards))
    whole = np.array([int(np.floor(r.target + 0.5)) for r in table], np.int64)
    quotas = -(-whole // block_words)
    cuts = np.cumsum(splitting_tree(quotas, depth, seed), axis=0) if len(table) else np.zeros((1, 0), np.int64)
    plan = {r.source: (int(w), int(q), cuts[:, k].copy(), r.source_size, r.target) for k, (r, w, q) in enumerate(zip(table, whole, quotas, strict=True))}
    shared = spark.sparkContext.broadcast(plan)
    placed = permuted(sized, f"{seed}:", rows)

    def cut(it):
        for batch in it:
            yield _pieces(batch, shared.value, block_words, seed)

    ddl = "row long, doc_id long, source string, size long, source_size long, target double, shard int, place long, block long, words long, turn int"
    return placed.select("row", "doc_id", "source", "size", "begin", F.xxhash64("h").alias("h")).mapInArrow(cut, ddl)


def _pieces(batch: pa.RecordBatch, plan: dict, block_words: int, seed: int) -> pa.RecordBatch:
    """The takings of the documents from the repeated streams, each with the shard of its block."""
    sources = batch.column("source").to_pylist()
    col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    size, begin, h = (col(c).astype(np.int64) for c in ("size", "begin", "h"))
    period = np.array([plan[s][3] for s in sources], np.int64)
    target = np.array([plan[s][4] for s in sources], np.float64)
    total = np.array([plan[s][0] for s in sources], np.int64)
    turns = np.where((size > 0) & (period > 0), np.maximum(-(-(total - begin) // np.maximum(period, 1)), 0), 0)
    at = np.repeat(np.arange(len(size)), turns)
    turn = np.arange(len(at)) - np.repeat(np.cumsum(turns) - turns, turns)
    start = begin[at] + turn * period[at]
    words = np.minimum(size[at], total[at] - start)
    block, shard = start // block_words, np.zeros(len(at), np.int32)
    codes = {s: k for k, s in enumerate(dict.fromkeys(sources))}
    code = np.array([codes[s] for s in sources], np.int64)[at] if len(at) else np.zeros(0, np.int64)
    for s, k in codes.items():
        if len(mine := np.flatnonzero(code == k)):
            quota, cuts = plan[s][1:3]
            shard[mine] = np.searchsorted(cuts, permute(block[mine], quota, seed, s), "right")
    place = hashed(h[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * turn.astype(np.uint64)).astype(np.int64)
    none = np.flatnonzero(turns == 0)
    every, pad = np.concatenate([at, none]), len(none)
    fill = lambda x, kind: pa.array(np.concatenate([x, np.zeros(pad, x.dtype)]), kind, mask=np.concatenate([np.zeros(len(x), bool), np.ones(pad, bool)]))
    same = [batch.column(c).take(pa.array(every)) for c in ("row", "doc_id", "source", "size")]
    words = np.concatenate([words, np.zeros(pad, np.int64)])
    return pa.RecordBatch.from_arrays(
        [*same, pa.array(period[every]), pa.array(target[every]), fill(shard, pa.int32()), fill(place, pa.int64()), fill(block, pa.int64()), pa.array(words, pa.int64()), fill(turn.astype(np.int32), pa.int32())],
        ["row", "doc_id", "source", "size", "source_size", "target", "shard", "place", "block", "words", "turn"],
    )


def permute(block: np.ndarray, quota: int, seed: int, source: str | None) -> np.ndarray:
    """A bijection of 0 .. quota - 1, drawn by seed and source: four Feistel rounds, repeated until within the range."""
    half = np.uint64(max(1, (max(quota - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    key = int.from_bytes(hashlib.md5(f"{seed}:{'' if source is None else '=' + source}".encode()).digest()[:8], "little")
    keys = hashed(np.uint64(key) + np.arange(4, dtype=np.uint64))
    out, todo = block.astype(np.uint64), np.arange(len(block))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & low
        for k in keys:
            left, right = right, left ^ (hashed(right + k) & low)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(quota)]
    return out.astype(np.int64)


@shipped
def mixed(docs: DataFrame, *, length: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` as the shards hold them, with all their columns: shard by shard, in the order of places.

    A document comes once for each piece, its text cut after the piece's last word where that isn't the whole; ``length``
    names a column that then becomes the number of characters left.  Texts are shuffled once, to their shards; a shard is
    written by a few tasks, each with a stretch of its places.
    """
    columns, kinds = docs.columns, docs.schema
    key, shard, place = (unused(docs, c) for c in ("row_key", "shard", "place"))
    keyed = with_row_key(docs, key)
    pieces = mix(keyed, row=key, **options).filter("shard is not null")
    folder = Places.put(pieces.select(F.col("row").alias(key), "shard", "place", "size", "words", "turn"), key, "pieces")

    def put(it):
        side = Places(folder)
        for batch in it:
            if not batch.num_rows:
                continue
            rows = batch.column(key).to_numpy()
            for at, piece in side.matches(rows, key):
                for k in range(0, len(at), 4096):
                    yield _cut_rows(batch, at[k : k + 4096], piece.slice(k, 4096), columns, length, shard, place)
        side = batch = rows = at = piece = None
        release()

    out = keyed.mapInArrow(put, StructType([*kinds.fields, StructField(shard, IntegerType()), StructField(place, LongType())]))
    # places are uniform, so their highest bits cut a shard evenly
    return out.repartition(shard, F.shiftright(place, 61)).sortWithinPartitions(shard, place).select(*(F.col(f"`{c}`") for c in columns))


def _cut_rows(batch: pa.RecordBatch, at: np.ndarray, piece: pa.Table, columns: list[str], length: str | None, shard: str, place: str) -> pa.RecordBatch:
    """Rows ``at`` of the batch as pieces."""
    out = batch.select(columns).take(pa.array(at))
    size, words = piece.column("size").to_numpy(), piece.column("words").to_numpy()
    cut = np.flatnonzero(words < size)
    if len(cut):
        k = columns.index("text")
        text = out.column(k).to_pylist()
        for j in cut.tolist():
            end = next(itertools.islice(re.finditer(WORD, text[j]), int(words[j]) - 1, None)).end()
            text[j] = text[j][:end]
        arrays = out.columns
        arrays[k] = pa.array(text, out.schema.field(k).type)
        if length in columns:
            n, m = columns.index(length), out.column(columns.index(length)).to_pylist()
            for j in cut.tolist():
                m[j] = len(text[j])
            arrays[n] = pa.array(m, out.schema.field(n).type)
        out = pa.RecordBatch.from_arrays(arrays, schema=out.schema)
    return pa.RecordBatch.from_arrays([*out.columns, *(piece.column(c).combine_chunks() for c in ("shard", "place"))], [*columns, shard, place])


def taken(pieces: DataFrame) -> DataFrame:
    """What the mix takes of each document: (doc_id, size, source_size, target, taken, pieces, shards).

    ``shards`` lists shard and place within it of each piece, in the order of the passes.
    """
    where = F.struct("turn", "shard", "place")
    out = pieces.groupBy("row", "doc_id", "size", "source_size", "target").agg(F.sum("words").alias("taken"), F.count("shard").cast("int").alias("pieces"), F.array_sort(F.collect_list(F.when(F.col("shard").isNotNull(), where))).alias("at"))
    shards = F.array_join(F.transform("at", lambda x: F.concat_ws(":", x["shard"], x["place"])), ",")
    return out.select("doc_id", "size", "source_size", "target", "taken", "pieces", shards.alias("shards"))
