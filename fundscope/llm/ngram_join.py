"""N-gram Jaccard join by chosen paths, and the near-duplicate classes that it gives.

Documents are sets of hashed five-word shingles (the whole text, if shorter; no set without words).  Equal sets are one
member.  A run walks a tree over the members: at a node, each of the ``SIGNATURE`` minhash coordinates is chosen with
probability 1 / (similarity * SIGNATURE), and a member goes to the child of each chosen coordinate's value, so two
members of similarity s stay together at an expected s / similarity children.  Nodes of up to ``small`` members are
brute-forced; larger ones are split on, down to ``deepest``.  Runs repeat until a pair of just the wanted similarity
meets at the target recall even at the deepest level.

What meets becomes an edge (in small nodes if the signatures agree well enough, in the few large nodes at the deepest
level to the first members of parts of the node); connected edges form groups, and within a group every pair is verified on the whole
shingle sets, of 64-bit hashes, in blocks.  So pairs never become rows: a verified block yields each member's number of
links and a spanning forest.  Only the texts of grouped members are cut into shingles again, and each of their sets is
shuffled once: the tasks for two blocks of a large group read these from the shared store.

Nulls and repeats: null texts and texts without words are alone in their class and have no links, even to each other; a
repeated document is a copy like any other; a null doc_id takes part, and a class is named by its least id that isn't
null.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import Cells, Places, groups, put_cells, shared_dir, spread_join, with_row_key, written
from .components import components, forest
from .words import Words, batches, grams, mix

SHINGLE, SIGNATURE = 5, 128
_ADD = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64))
_MUL = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64) + np.uint64(1 << 32)) | np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's words."""
    return np.unique(grams(words, SHINGLE))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minhash values, a row per set; no set is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SIGNATURE), np.uint32)
    for k in range(SIGNATURE):
        out[:, k] = np.minimum.reduceat(((flat + _ADD[k]) * _MUL[k]) >> np.uint64(32), starts)
    return out


def _sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, "text", 1 << 20):
        words = Words(batch.column("text"))
        sets = [shingles(w) for w in words.rows()]
        full = [k for k, s in enumerate(sets) if len(s)]
        sig = signatures([sets[k] for k in full]) if full else np.zeros((0, SIGNATURE), np.uint32)
        rid, n, signed = ([None] * len(sets) for _ in range(3))
        for k, s in zip(full, sig, strict=True):
            x = sets[k]
            rid[k] = int((mix(x).sum(dtype=np.uint64) ^ np.uint64(len(x))).astype(np.int64))
            n[k], signed[k] = len(x), s.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(rid, pa.int64()), pa.array(n, pa.int32()), pa.array(signed, pa.binary())], ["row", "doc_id", "rid", "n", "sig"])


def _contents(folder: str):
    """Shingle sets of the rows that the side table names, with what it says of them."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = Places(folder)
        for batch in batches(it, "text", 4 << 20):
            for at, member in side.matches(batch.column("row").to_numpy(), "row"):
                words = Words(batch.column("text").take(pa.array(at)))
                sets = pa.array([shingles(w).tobytes() for w in words.rows()], pa.binary())
                for k in range(0, len(at), 256):
                    yield pa.RecordBatch.from_arrays([*(member.column(c).slice(k, 256).combine_chunks() for c in _MEMBER), sets.slice(k, 256)], [*_MEMBER, "shingles"])

    return run


_MEMBER = ("group", "blocks", "block", "rid", "copies", "n")


def meeting(depth: int, ratio: float = 1.0) -> float:
    """Probability that two members share a node at ``depth``: a branching process with Poisson(ratio) children."""
    p = 1.0
    for _ in range(depth):
        p = 1 - np.exp(-ratio * p)
    return float(p)


def _children(sig: np.ndarray, node: np.ndarray, similarity: float, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of every row's chosen coordinates; rows of one node choose the same ones."""
    limit = np.uint64(int(2**64 / (similarity * SIGNATURE)))
    rows, kids = [], []
    for k in range(SIGNATURE):
        chosen = np.flatnonzero(mix(node + np.uint64((salt * SIGNATURE + k) * 0x9E3779B97F4A7C15 % 2**64)) < limit)
        if len(chosen):
            rows.append(chosen)
            kids.append(mix(mix(node[chosen] + np.uint64(k + 1)) ^ sig[chosen, k].astype(np.uint64)))
    return (np.concatenate(rows), np.concatenate(kids)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _first_nodes(runs: int, depth: int, similarity: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                sig, rid = _matrix(part.column("sig"), np.uint32, SIGNATURE), part.column("rid").to_numpy(zero_copy_only=False)
                rows, nodes = [], []
                for r in range(runs):
                    row, node = np.arange(len(rid)), np.full(len(rid), mix(np.array([r + 1], np.uint64))[0])
                    for d in range(depth):
                        up, node = _children(sig[row], node, similarity, d)
                        row = row[up]
                    rows.append(row)
                    nodes.append(node)
                yield _node_rows(rid[np.concatenate(rows)], np.concatenate(nodes))

    return run


def _next_nodes(depth: int, similarity: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                node = part.column("node").to_numpy(zero_copy_only=False).astype(np.uint64)
                up, kids = _children(_matrix(part.column("sig"), np.uint32, SIGNATURE), node, similarity, depth)
                yield _node_rows(part.column("rid").to_numpy(zero_copy_only=False)[up], kids)

    return run


def _node_rows(rid: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node.astype(np.int64)), pa.array(rid)], ["node", "rid"])


def _near(similarity: float, deviations: float = 4.0):
    """Edges among the members of small nodes whose sizes and signatures allow the similarity."""
    least = similarity - deviations * np.sqrt(similarity * (1 - similarity) / SIGNATURE)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, table in groups(it, ["node"]):
            rid, n = (table.column(c).to_numpy() for c in ("rid", "n"))
            low = _matrix(table.column("low"), np.uint8, SIGNATURE)
            a, b = np.triu_indices(len(rid), 1)
            fits = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b])
            a, b = a[fits], b[fits]
            agree = (low[a] == low[b]).mean(axis=1)
            close = agree >= least + (1 - least) / 256
            out += zip(rid[a[close]].tolist(), rid[b[close]].tolist(), strict=True)
            if len(out) > 20_000:
                yield _edge_rows(out)
                out = []
        yield _edge_rows(out)

    return run


def _edge_rows(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    edges = list({(min(e), max(e)) for e in edges})
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["u", "v"])


def _starred(big: DataFrame, rows: int = 1024) -> DataFrame:
    """Edges that connect all members of each node of (node, rid, members): stars of about ``rows``, and one of their heads."""
    part = F.pmod(F.xxhash64("rid"), F.ceil(F.col("members") / rows)).alias("part")
    stars = big.select("node", part, "rid").repartition("node", "part").sortWithinPartitions("node", "part", "rid").mapInArrow(_stars(["node", "part"]), "node long, u long, v long")
    stars = written(stars, shared_dir(big.sparkSession, "stars"))
    heads = stars.filter("u = v").select("node", F.col("u").alias("rid")).repartition("node").sortWithinPartitions("node", "rid")
    return stars.unionByName(heads.mapInArrow(_stars(["node"]), "node long, u long, v long")).filter("u <> v").select("u", "v")


def _stars(by: list[str]):
    """(node, first member, member) of each group, the first member with itself included."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in groups(it, by):
            rid = table.column("rid").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rid), x, np.int64)) for x in (key[0], rid.min())] + [pa.array(rid)], ["node", "u", "v"])

    return run


def candidate_edges(members: DataFrame, similarity: float, recall: float, small: int, first: int = 2, deepest: int = 5) -> DataFrame:
    """(u, v): members that meet in a node of the chosen paths.  ``members``: rid, n, sig."""
    spark = members.sparkSession
    runs = int(np.ceil(np.log(1 - recall) / np.log(1 - meeting(deepest))))
    nodes = written(members.select("rid", "sig").mapInArrow(_first_nodes(runs, first, similarity), "node long, rid long"), shared_dir(spark, "paths"))
    edges, depth = [], first
    while True:
        counts = written(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), shared_dir(spark, "nodes"))
        met = nodes.join(counts.filter(F.col("members") <= small), "node")
        met = met.join(members.select("rid", "n", _low_bytes(F.col("sig")).alias("low")), "rid").select("node", "rid", "n", "low")
        edges.append(met.repartition("node").sortWithinPartitions("node", "rid").mapInArrow(_near(similarity), "u long, v long"))
        large = counts.filter(F.col("members") > small)
        if large.isEmpty():
            break
        big = nodes.join(large, "node")
        if depth == deepest:
            edges.append(_starred(big))
            break
        nodes = written(big.join(members.select("rid", "sig"), "rid").select("node", "rid", "sig").mapInArrow(_next_nodes(depth, similarity), "node long, rid long"), shared_dir(spark, "paths"))
        depth += 1
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _low_bytes(sig):
    """The lowest byte of each little-endian coordinate."""
    return F.unhex(F.regexp_replace(F.hex(sig), "(..)......", "$1"))


def intersections(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of ``sets`` with ``others``, by products of 0/1 matrices over shared values."""
    values = np.concatenate([*sets, *others])
    owner = np.repeat(np.arange(len(sets) + len(others)), [len(s) for s in (*sets, *others)])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    code = np.cumsum(new) - 1
    shared = np.bincount(code) > 1
    keep = shared[code]
    column = (np.cumsum(shared) - 1)[code[keep]]
    owner, out = owner[keep], np.zeros((len(sets), len(others)), np.float32)
    step = 4096
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + 1 + step, step))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            part = np.zeros((len(sets) + len(others), step), np.float32)
            part[owner[a:b], column[a:b] - k * step] = 1
            out += part[: len(sets)] @ part[len(sets) :].T
    return out


class _Block:
    """Members of one block, each once."""

    def __init__(self, table: pa.Table):
        rid, first = np.unique(table.column("rid").to_numpy(), return_index=True)
        self.rid, self.copies, self.n = rid, *(table.column(c).to_numpy()[first] for c in ("copies", "n"))
        raw = table.column("shingles")
        self.sets = [np.frombuffer(raw[int(k)].as_py(), np.uint64) for k in first]


def _links(a: _Block, b: _Block, similarity: float) -> list[tuple[int, int, int]]:
    """Rows (kind, a, b): 0, member, links found here; 1, two linked members (a forest)."""
    rows, same = [], a is b
    for k in range(0, len(a.rid), 256):
        mine = slice(k, k + 256)
        inter = intersections(a.sets[mine], b.sets)
        linked = inter * (1 + similarity) >= similarity * (a.n[mine][:, None] + b.n[None, :]) - 1e-6
        linked &= a.rid[mine][:, None] != b.rid[None, :]
        x, y = np.nonzero(linked)
        rows += [(0, int(r), int(c)) for r, c in zip(a.rid[mine], linked @ b.copies, strict=True) if c]
        if not same:
            rows += [(0, int(r), int(c)) for r, c in zip(b.rid, linked.T @ a.copies[mine], strict=True) if c]
        rows += [(1, u, v) for u, v in forest(a.rid[mine][x], b.rid[y])]
    return rows


def _verified(similarity: float):
    """Links within groups of a single block."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int]] = []
        for _, table in groups(it, ["group"]):
            block = _Block(table)
            rows += _links(block, block, similarity)
            if len(rows) > 50_000:
                yield _rows(rows)
                rows = []
        yield _rows(rows)

    return run


def _verified_blocks(similarity: float, folder: str):
    """Links between two blocks of a group; tasks get those of one left block in a row."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, held = Cells(folder, 1), {}

        def block(group: int, k: int) -> _Block:
            if (group, k) not in held:
                table = cells[group, k]
                held[group, k] = None if table is None else _Block(table)
            return held[group, k]

        for batch in it:
            for group, left, right in zip(*(batch.column(c).to_pylist() for c in ("group", "left", "right")), strict=True):
                for key in [k for k in held if k not in ((group, left), (group, right))]:
                    del held[key]
                a, b = block(group, left), block(group, right)
                if a is not None and b is not None:
                    yield _rows(_links(a, b, similarity))

    return run


def _rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["kind", "a", "b"])


@shipped
def near_duplicates(docs: DataFrame, *, similarity: float = 0.8, recall: float = 0.98, small: int = 64, block_members: int = 1024, block_shingles: int = 1 << 20, row: str | None = None) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs`` (doc_id, text).

    ``n_links`` counts the other documents of similarity ``similarity`` or more, exact copies among them; a class is
    a connected component of those links and is named by its least doc_id.  ``row`` is a column that numbers the rows of
    ``docs``; without it they are numbered by their places in the files.
    """
    spark = docs.sparkSession
    docs, row = (docs, row) if row else (with_row_key(docs.select("doc_id", "text")), "_row")
    docs = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = written(docs.mapInArrow(_sets, "row long, doc_id long, rid long, n int, sig binary"), shared_dir(spark, "sets"))
    members = sets.filter("rid is not null").groupBy("rid").agg(F.min("row").alias("row"), F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.max("sig").alias("sig"))
    members = written(members, shared_dir(spark, "members"))
    grouped = written(components(candidate_edges(members, similarity, recall, small)), shared_dir(spark, "groups"))

    slim = members.select("rid", "row", "rep", "copies", "n")
    grouped = grouped.join(slim.drop("rep"), "rid")
    size = grouped.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_members), F.ceil(F.sum("n") / block_shingles)).alias("blocks"), F.count(F.lit(1)).alias("many"))
    size = written(size, shared_dir(spark, "group-sizes"))
    placed = spread_join(grouped, size, "root", "many").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")))
    folder = Places.put(placed.select("row", F.col("root").alias("group"), "blocks", "block", "rid", "copies", "n"), "row", "grouped")
    ddl = "group long, blocks long, block long, rid long, copies long, n int, shingles binary"
    content = written(docs.select("row", "text").mapInArrow(_contents(folder), ddl), shared_dir(spark, "contents"), compression="zstd")
    checked = content.filter("blocks = 1").repartition("group").sortWithinPartitions("group").mapInArrow(_verified(similarity), _CHECKED)
    large = size.filter("blocks > 1")
    if not large.isEmpty():
        blocks = shared_dir(spark, "blocks")
        put_cells(content.filter("blocks > 1"), ["group", "block"], ["rid"], blocks)
        upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), c))
        pairs = large.select(F.col("root").alias("group"), "blocks", upto(F.col("blocks") - 1).alias("left")).select("group", "left", F.explode(F.sequence(F.col("left"), F.col("blocks") - 1)).alias("right"))
        tasks = max(1, -(-pairs.count() // 4))
        checked = checked.unionByName(pairs.repartitionByRange(tasks, "group", "left", "right").sortWithinPartitions("group", "left", "right").mapInArrow(_verified_blocks(similarity, blocks), _CHECKED))
    checked = written(checked, shared_dir(spark, "links"))

    links = checked.filter("kind = 0").groupBy(F.col("a").alias("rid")).agg(F.sum("b").alias("links"))
    forests = checked.filter("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v"))
    classes = written(components(forests).join(slim.select("rid", "rep"), "rid"), shared_dir(spark, "classes"))
    names = written(classes.groupBy("root").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("many")), shared_dir(spark, "names"))
    classes = spread_join(classes, names, "root", "many").select("rid", "class_id")
    known = slim.join(links, "rid", "left").join(classes, "rid", "left").select("rid", "copies", F.coalesce("class_id", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = written(known, shared_dir(spark, "known"))
    return _spread(sets.select("doc_id", "rid"), known)


_CHECKED = "kind int, a long, b long"


def _spread(rows: DataFrame, known: DataFrame, **options) -> DataFrame:
    """Members' results for all their copies; ``options`` are those of ``spread_join``."""
    some = spread_join(rows.filter("rid is not null"), known, "rid", "copies", **options).select("doc_id", "class_id", "n_links")
    none = rows.filter("rid is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none).select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_links")
