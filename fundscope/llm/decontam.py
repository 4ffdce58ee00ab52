"""Benchmark decontamination by CGK embedding, bit sampling and exact edit distance, over words.

A passage of a document leaks an item if some stretch of the document is within ``floor((1 - similarity) * words)`` word
edits (insert, delete, replace) of the whole item.  Words are those of ``fundscope.llm.words``.

* CGK embedding: a pointer walks along a window; at step j it emits the word under it and moves on by the j-th random
  bit of that word.  Windows at a small edit distance give walks at a small Hamming distance, as pointers that part
  meet again.
* Bit sampling: a repetition hashes a few sampled steps of one walk; equal hashes make a candidate.  Windows have the
  size of the items: sizes form classes a quarter apart, each with its own steps.
* On a long window the pointers drift too far apart to meet again, whatever the number of repetitions.  An item of more
  than ``LONGEST`` words is therefore cut into equal parts, each with windows of its size: of e edits, some part among m
  has e // m at most, so that part lies as near to its window as a short item does.  Verification is on the whole item.
* For every class fresh walks are added until items with as many random edits as allowed are found at the target
  recall; ``recall_reached`` reports it.  A class that the last walk leaves short of it is searched exactly: every open
  window meets every item of the class.
* A gate spares walks that cannot lead anywhere: e edits among n words break at most e * g of the n - g + 1 runs of g
  words, so a window that shares fewer runs than remain with the items is skipped.  It loses nothing.
* Candidates are verified by bit-parallel edit distance over the whole item and the window with its margins.

Items are indexed in blocks whose index, not text, is bounded in bytes.  The driver builds one block at a time and
leaves it in the shared folder, where tasks read one at a time; the documents are read once for any number of blocks.

Nulls and repeats: null and empty texts match nothing; items without words are never leaked; equal rows of the benchmark
count once, items with equal texts and different ids are each reported; a repeated document is reported each time.  An
empty table on either side gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import open_fs, shared_dir, unused
from .words import Words, grams, mix

PAD = np.uint64(0)
GATE = 3
SAMPLED = 3
LONGEST = 64
_CHUNK = 2 << 20
_DDL = "doc_id long, item_id long, edits int, item_words int, similarity double, word_from int, word_to int"


def allowed(words: int, similarity: float) -> int:
    return int((1 - similarity) * words + 1e-9)


def edit_distance(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """(distance, from, to): the stretch of ``text`` nearest to the whole ``pattern``; the first of the nearest."""
    n = len(pattern)
    best, end = _scan(pattern, text, free=True)
    back, length = _scan(pattern[::-1], text[:end][::-1], free=False)
    assert n == 0 or back == best
    return best, end - length, end


def _scan(pattern: list[int], text: list[int], free: bool) -> tuple[int, int]:
    """Least distance over all ends in ``text`` and the first such end; ``free``: the stretch may start anywhere."""
    n = len(pattern)
    full, top = (1 << n) - 1, 1 << max(n - 1, 0)
    where: dict[int, int] = defaultdict(int)
    for k, w in enumerate(pattern):
        where[w] |= 1 << k
    plus, minus, score = full, 0, n
    best, end = n, 0
    for j, w in enumerate(text, 1):
        eq = where.get(w, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full | (0 if free else 1)
        down = (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Index:
    """Sampled signatures of a block of items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, recall: float, walks: int = 32, per_walk: int = 16, probes: int = 400, seed: int = 1):
        words = Words(pa.array([t for _, t in items], pa.string()))
        kept = [(i, w) for (i, _), w in zip(items, words.rows(), strict=True) if len(w)]
        self.ids = [i for i, _ in kept]
        self.words = [w.copy() for _, w in kept]
        self.edits = [allowed(len(w), similarity) for w in self.words]
        self.recall, self.walks, self.per_walk, self.probes, self.seed = recall, walks, per_walk, probes, seed
        by_class: dict[int, list[int]] = defaultdict(list)
        for k, w in enumerate(self.words):
            by_class[self._class(len(w) // self._parts(len(w)))].append(k)
        self._gates(by_class)
        rng = np.random.default_rng(seed)
        self.classes = [self._tables(size, by_class[size], rng) for size in sorted(by_class)]

    @staticmethod
    def _parts(n: int) -> int:
        return -(-n // LONGEST)

    def _cuts(self, k: int) -> list[int]:
        """First words of the item's parts, and its end."""
        n = len(self.words[k])
        m = self._parts(n)
        return [j * n // m for j in range(m + 1)]

    @property
    def nbytes(self) -> int:
        arrays = [*self.words, *self.own.values(), *(x for pair in self.gates.values() for x in pair)]
        arrays += [x for c in self.classes for x in (c["item"], c["offset"], *(y for t in c["tables"] for y in t[2:]))]
        return sum(x.nbytes for x in arrays)

    @staticmethod
    def _class(n: int) -> int:
        size = 1
        while (up := max(size + 1, size * 5 // 4)) <= n:
            size = up
        return size

    def _gates(self, by_class: dict[int, list[int]]) -> None:
        """By run length: the parts' runs. By class: run length, least number of shared runs, longest stretch."""
        runs, self.needs, own = defaultdict(list), {}, defaultdict(list)
        for c, members in by_class.items():
            for k in members:
                cuts = self._cuts(k)
                e = self.edits[k] // (len(cuts) - 1)
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    n = b - a
                    size = next(g for g in range(GATE, 0, -1) if n - g + 1 - e * g >= 1 or g == 1)
                    need = (size, max(1, n - size + 1 - e * size), n + e)
                    old = self.needs.setdefault((c, size), need)
                    self.needs[c, size] = (size, min(old[1], need[1]), max(old[2], need[2]))
                    runs[size].append(grams(self.words[k][a:b], size))
                    own[c, size].append(runs[size][-1])
        self.own = {key: np.unique(np.concatenate(x)) for key, x in own.items()}
        self.gates = {}
        for size, found in runs.items():
            hashes = np.unique(np.concatenate(found))
            table = np.zeros(1 << 20, bool)
            table[hashes >> np.uint64(44)] = True
            self.gates[size] = (hashes, table)

    def walk(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Words emitted and pointers' distances from the start, a row per step and a column per window."""
        factors = mix(np.arange(1, steps + 1, dtype=np.uint64) + np.uint64(1_000_003 * (walk + 1) + self.seed)) | np.uint64(1)
        out, at = np.empty((steps, len(starts)), np.uint64), np.empty((steps, len(starts)), np.int32)
        pos, last = starts.copy(), len(hashes) - 1
        for j in range(steps):
            word = np.where(pos < ends, hashes[np.minimum(pos, last)], PAD)
            out[j], at[j] = word, pos - starts
            pos += ((word * factors[j]) >> np.uint64(63)).astype(np.int64)
            # a pad has no bits: the pointer stays, and all further words are pads
        return out, at

    @staticmethod
    def signature(out: np.ndarray, at: np.ndarray, steps: np.ndarray, size: int) -> np.ndarray:
        sig = np.zeros(out.shape[1], np.uint64)
        for j in steps:
            sig = sig * np.uint64(0x9FB21C651E98DF25) + np.where(at[j] < size, out[j], PAD) + np.uint64(1)
        return mix(sig)

    def _tables(self, size: int, members: list[int], rng) -> dict:
        """Signatures of the parts of the class's items, a walk more until edited items are found at the recall."""
        item, offset, part_of = [], [], {}
        for k in members:
            for a in self._cuts(k)[:-1]:
                part_of[k, a] = len(item)
                item.append(k)
                offset.append(a)
        flat, starts, ends = self._flat([self.words[k] for k in members])
        first = dict(zip(members, starts.tolist(), strict=True))
        starts = np.array([first[k] + a for k, a in zip(item, offset, strict=True)])
        ends = np.array([first[k] + len(self.words[k]) for k in item])
        # edited items, and where the image of each part begins in them
        probed = [members[i * len(members) // self.probes if len(members) > self.probes else i % len(members)] for i in range(self.probes)]
        edited = [self._edited(self.words[k], self.edits[k], rng) for k in probed]
        e_flat, e_from, e_to = self._flat([w for w, _ in edited])
        e_starts, e_ends, of, part = [], [], [], []
        for p, (k, (_, origin)) in enumerate(zip(probed, edited, strict=True)):
            for a in self._cuts(k)[:-1]:
                e_starts.append(e_from[p] + int(np.searchsorted(origin, a)))
                e_ends.append(e_to[p])
                of.append(p)
                part.append(part_of[k, a])
        e_starts, e_ends, of, part = map(np.array, (e_starts, e_ends, of, part))
        found, tables = np.zeros(self.probes, bool), []
        for w in range(self.walks):
            out, at = self.walk(flat, starts, ends, w, 2 * size)
            e_out, e_at = self.walk(e_flat, e_starts, e_ends, w, 2 * size)
            for _ in range(self.per_walk):
                chosen = np.sort(rng.integers(0, 2 * size, SAMPLED))
                sig = self.signature(out, at, chosen, size)
                found[of[self.signature(e_out, e_at, chosen, size) == sig[part]]] = True
                order = np.argsort(sig, kind="stable")
                tables.append((w, chosen, sig[order], order.astype(np.int32)))
            if found.mean() >= self.recall:
                break
        return {"size": size, "tables": tables, "recall": float(found.mean()), "item": np.array(item, np.int32), "offset": np.array(offset, np.int32)}

    @staticmethod
    def _edited(words: np.ndarray, edits: int, rng) -> tuple[np.ndarray, np.ndarray]:
        """(words after random edits, place in the item of each; an inserted word has that of the word after it)."""
        out, origin = words.tolist(), list(range(len(words)))
        for _ in range(edits):
            kind, k = rng.integers(3), int(rng.integers(len(out) + 1))
            if kind == 0 or not out:
                out.insert(k, int(rng.integers(1, 1 << 63)))
                origin.insert(k, origin[k] if k < len(origin) else len(words))
            elif kind == 1:
                del out[min(k, len(out) - 1)], origin[min(k, len(origin) - 1)]
            else:
                out[min(k, len(out) - 1)] = int(rng.integers(1, 1 << 63))
        return np.array(out, np.uint64), np.array(origin, np.int64)

    @staticmethod
    def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(r) for r in rows])
        return np.concatenate([*rows, np.zeros(1, np.uint64)]), ends - [len(r) for r in rows], ends

    def open_starts(self, words: Words) -> dict[int, np.ndarray]:
        """By class: positions whose window shares as many runs of words with items as a leak of that size must."""
        n, out = len(words.hashes), defaultdict(list)
        doc = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))
        for size, (hashes, table) in self.gates.items():
            if n < size:
                continue
            run = grams(words.hashes, size)
            at = np.flatnonzero(table[run >> np.uint64(44)])
            if not len(at):
                continue
            near = np.minimum(np.searchsorted(hashes, run[at]), len(hashes) - 1)
            at = at[(hashes[near] == run[at]) & (doc[at] == doc[at + size - 1])]
            for (c, g), (_, least, reach) in self.needs.items():
                if g != size:
                    continue
                mine = at[np.isin(run[at], self.own[c, g])]
                if not len(mine):
                    continue
                # starts lie up to the reach before a shared run, in its document
                first = np.maximum(mine - reach + 1, words.offsets[doc[mine]])
                first[1:] = np.maximum(first[1:], mine[:-1] + 1)
                many = mine - first + 1
                start = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
                stop = np.minimum(start + reach, words.offsets[doc[start] + 1])
                out[c].append(start[np.searchsorted(mine, stop) - np.searchsorted(mine, start) >= least])
        return {c: np.unique(np.concatenate(x)) for c, x in out.items()}

    def candidates(self, words: Words) -> dict[tuple[int, int], set[int]]:
        """Places where the item would begin, by (row, item)."""
        out: dict[tuple[int, int], set[int]] = defaultdict(set)
        opened = self.open_starts(words)
        for c in self.classes:
            item, offset, steps = c["item"], c["offset"], 2 * c["size"]
            starts, block = opened.get(c["size"], np.zeros(0, np.int64)), max(64, (1 << 21) // steps)
            for k in range(0, len(starts), block):
                some = starts[k : k + block]
                row = np.searchsorted(words.offsets, some, "right") - 1
                if c["recall"] < self.recall:
                    # the walks fall short of the recall: all open windows meet all parts of the class
                    for r in np.unique(row).tolist():
                        here = some[row == r]
                        for i, o in zip(item.tolist(), offset.tolist(), strict=True):
                            out[r, i].update((here - o).tolist())
                    continue
                for w in range(c["tables"][-1][0] + 1):
                    emitted, at = self.walk(words.hashes, some, words.offsets[row + 1], w, steps)
                    for walk, chosen, sigs, parts in c["tables"][w * self.per_walk : (w + 1) * self.per_walk]:
                        assert walk == w
                        sig = self.signature(emitted, at, chosen, c["size"])
                        a = np.searchsorted(sigs, sig)
                        for j in np.flatnonzero(sigs[np.minimum(a, len(sigs) - 1)] == sig):
                            for m in parts[a[j] : np.searchsorted(sigs, sig[j], "right")]:
                                out[int(row[j]), int(item[m])].add(int(some[j] - offset[m]))
        return out

    def leaks(self, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, edits, from, to) of verified leaks, the nearest stretch of each row and item."""
        for (row, item), starts in sorted(self.candidates(words).items()):
            begin, stop = int(words.offsets[row]), int(words.offsets[row + 1])
            n, e, best = len(self.words[item]), self.edits[item], None
            pattern, spans = self.words[item].tolist(), []
            for s in sorted(starts):
                a, b = max(begin, s - 2 * e - 1), min(stop, s + n + 2 * e + 1)
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            for a, b in spans:
                d, x, y = edit_distance(pattern, words.hashes[a:b].tolist())
                if d <= e and (best is None or d < best[0]):
                    best = (d, a + x - begin, a + y - begin)
            if best:
                yield row, item, *best


_HELD: dict[str, Index] = {}


def _index(path: str) -> Index:
    """The block's index; a worker holds one at a time."""
    if path not in _HELD:
        _HELD.clear()
        fs, place = open_fs(path)
        with fs.open_input_stream(place) as f:
            _HELD[path] = pickle.loads(f.read())
    return _HELD[path]


def _searcher(paths: list[str]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import batches

        for batch in batches(it, "text", _CHUNK * min(4, len(paths))):
            words, ids = Words(batch.column("text")), batch.column("doc_id").to_pylist()
            for path in paths:
                index = _index(path)
                rows = [(ids[r], index.ids[i], d, len(index.words[i]), 1 - d / len(index.words[i]), a, b) for r, i, d, a, b in index.leaks(words)]
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _DDL.split(", ")])

    return run


@shipped
def find_leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = 0.8, recall: float = 0.995, block_bytes: int = 4 << 20, index_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, item_id, edits, item_words, similarity, word_from, word_to), one row per document and leaked item.

    A block holds items of about ``block_bytes`` of text, and fewer where its index would exceed ``index_bytes`` (a
    single item is a block at any size).  The documents are read once, and nothing is shuffled.
    """
    paths = _indexes(benchmark, similarity, recall, block_bytes, index_bytes)
    searched = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return searched.mapInArrow(_searcher(paths), _DDL)


def _indexes(benchmark: DataFrame, similarity: float, recall: float, block_bytes: int, index_bytes: int) -> list[str]:
    """Files with the indexes of blocks of items, one at least."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    folder = shared_dir(benchmark.sparkSession, "leak-index")
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    paths: list[str] = []
    for k in range(blocks):
        mine = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        todo = [sorted(((r.item_id, r.text) for r in mine.collect()), key=lambda r: (r[0] is None, r))]
        while todo:
            some = todo.pop()
            index = Index(some, similarity, recall)
            if index.nbytes > index_bytes and len(some) > 1:
                todo += [some[len(some) // 2 :], some[: len(some) // 2]]
                continue
            with fs.open_output_stream(f"{root}/block-{len(paths):05d}") as f:
                f.write(pickle.dumps(index, 5))
            paths.append(f"{folder}/block-{len(paths):05d}")
    return paths


def recall_reached(benchmark: DataFrame, *, similarity: float = 0.8, recall: float = 0.995, block_bytes: int = 4 << 20, index_bytes: int = 64 << 20) -> list[dict]:
    """Per block and class of item sizes: window words, items, tables, measured recall, and if it is searched exactly."""
    out = []
    for path in _indexes(benchmark, similarity, recall, block_bytes, index_bytes):
        index = _index(path)
        out += [{"words": c["size"], "items": len(np.unique(c["item"])), "tables": len(c["tables"]), "recall": c["recall"], "exact": c["recall"] < recall} for c in index.classes]
    _HELD.clear()
    return out


@shipped
def without_leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = 0.8, recall: float = 0.995, block_bytes: int = 4 << 20, index_bytes: int = 64 << 20) -> DataFrame:
    """Rows of ``docs`` that leak no item, with all their columns: one pass, without a join."""
    columns, schema, searched = docs.columns, docs.schema, unused(docs, "searched")
    paths = _indexes(benchmark, similarity, recall, block_bytes, index_bytes)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import batches

        for batch in batches(it, searched, _CHUNK * min(4, len(paths))):
            clean, words = np.ones(batch.num_rows, bool), Words(batch.column(searched))
            for path in paths:
                clean[[row for row, *_ in _index(path).leaks(words)]] = False
            yield batch.filter(pa.array(clean)).select(columns)

    return docs.withColumn(searched, F.col("text").cast("string")).mapInArrow(run, schema)
