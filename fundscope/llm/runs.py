"""Periodic runs of whole texts: Lyndon roots under both orders, extended by hashed comparisons.

A run is a stretch of words with smallest period p that no neighbouring word extends, of at least ``min_words`` words and
``min_exponent`` periods.  Words are runs of anything but ASCII blanks, told apart by their bytes.

Two places of a run that are a period apart start with equal words, two thirds of a run of three periods at least.  So only
stretches of windows of so many words that come twice in a document are scanned; no run lies elsewhere or reaches out of
them.  The words of a stretch are numbered and a stack scans them from right to left, once for each order of the numbers:
the longest Lyndon word from word i ends where the first smaller suffix begins.  Every run has its period as such a word's
length under one of the orders.  A Lyndon word that repeats at once is extended to both sides as far as words p apart are
equal; how far is found by a binary search over rolling hashes, and the words found equal are then compared one with the
other.  The same extension serves the stack's comparisons, and keeps the stretches already known for each distance, so a text
that repeats one word costs no more than another.  Work and memory are in proportion to a document's words, but for the
logarithm of the searches; documents are independent, so a repeated one or a hot source is nothing special.

Nulls: a null text has no words, no runs and an empty collapsed text; a null id is carried.  Repeated rows give repeated
results, an empty table none.  Columns that aren't named are carried along untouched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..shipping import shipped
from .words import UNSPACED, Words, batches, grams, mix

#: Words that comparisons look at before they turn to hashes.
_DIRECT = 4
_BASE = 0x9E3779B97F4A7C15 | 1


class Sequence:
    """Words as numbers, with what tells how far two places agree."""

    def __init__(self, codes: list[int]):
        self.codes, self.n = codes, len(codes)
        self.array = np.array(codes, np.int64)
        self.known: dict[int, tuple[int, int]] = {}
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        """Rolling hashes of all beginnings, modulo 2**64: sums of mixed words times powers."""
        if self._hashes is None:
            powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(self.n, _BASE, np.uint64)]))
            values = mix(self.array.astype(np.uint64) + np.uint64(1)) * powers[: self.n]
            self._hashes, self._powers = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)]), powers
        return self._hashes

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at a and b, a before b, have equal hashes."""
        h = self.hashes
        return (h[a + length] - h[a]) * self._powers[b - a] == h[b + length] - h[b]

    def _search(self, a: int, b: int, most: int, step: int) -> int:
        """Words that agree from a and b on (step 1) or before them (step -1), by hashes, then word by word."""
        h, p = self.hashes, self._powers
        low, high = 0, most
        with np.errstate(over="ignore"):
            power = p[b - a]
            while low < high:
                mid = (low + high + 1) // 2
                x, y = (a, b) if step > 0 else (a - mid, b - mid)
                if (h[x + mid] - h[x]) * power == h[y + mid] - h[y]:
                    low = mid
                else:
                    high = mid - 1
        x, y = (a, b) if step > 0 else (a - low, b - low)
        one, two = self.array[x : x + low], self.array[y : y + low]
        if not np.array_equal(one, two):
            # a clash of hashes: the words decide
            differ = np.flatnonzero(one != two)
            low = int(differ[0]) if step > 0 else low - 1 - int(differ[-1])
        return low

    def common(self, a: int, b: int) -> int:
        """How many words from a on equal those from b on; a < b."""
        d = b - a
        start, end = self.known.get(d, (0, -1))
        if start <= a <= end:
            return end - a
        codes, k, stop = self.codes, a, min(start, a + 4 * _DIRECT)
        while k < stop and codes[k] == codes[k + d]:
            k += 1
        if k < stop:
            return k - a
        length = self._search(a, b, start - a, 1) if a < k < start else k - a if a < start else self._search(a, b, self.n - b, 1)
        if a + length == start:
            # it goes on as far as is known from there
            length = end - a
        self.known[d] = (a, a + length)
        return length

    def before(self, a: int, b: int) -> int:
        """How many words before a equal those before b; a < b."""
        return self._search(a, b, a, -1)

    def lyndon_ends(self, sign: int) -> list[int]:
        """Where the longest Lyndon word from each place ends, words ordered by their numbers (sign 1) or against (-1)."""
        w, n, common = self.codes if sign > 0 else [-c for c in self.codes], self.n, self.common
        ends = [0] * n
        for i in range(n - 1, -1, -1):
            j, first = i + 1, w[i]
            while j < n:
                other = w[j]
                if first == other:
                    k = 1
                    while k < _DIRECT and j + k < n and w[i + k] == w[j + k]:
                        k += 1
                    if k == _DIRECT and j + k < n:
                        k = common(i, j)
                    # the end of the text is smaller than any word
                    if j + k >= n or w[i + k] > w[j + k]:
                        break
                elif first > other:
                    break
                j = ends[j]
            ends[i] = j
        return ends

    def runs(self, min_words: int, min_exponent: int) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start and period.

        At least two whole roots follow each other in a run of three periods; longer exponents need no less.
        """
        found: set[tuple[int, int, int]] = set()
        if self.n < min_words:
            return []
        starts = np.arange(self.n)
        for sign in (1, -1):
            period = np.array(self.lyndon_ends(sign), np.int64) - starts
            may = np.flatnonzero((starts + 2 * period <= self.n) & (period * min_exponent <= self.n))
            may = may[self.equal(may, may + period[may], period[may])]
            by: dict[int, list[int]] = {}
            for i, p in zip(may.tolist(), period[may].tolist(), strict=True):
                by.setdefault(p, []).append(i)
            for p, places in by.items():
                k = 0
                while k < len(places):
                    i = places[k]
                    length = self.common(i, i + p)
                    k += 1
                    if length < p:
                        continue
                    start = i - self.before(i, i + p)
                    end = i + p + length
                    if end - start >= max(min_words, min_exponent * p):
                        found.add((start, end - start, p))
                    # other roots of this run lie before its end
                    k = max(k, bisect_left(places, end - 2 * p + 1))
        return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: all but those after the first period of a run that has them."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def repeated_stretches(hashes: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(start, end) of the maximal stretches that windows cover whose ``window`` hashes come twice or more."""
    if len(hashes) <= window:
        return []
    found = grams(hashes, window)
    ordered = np.sort(found)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(found, twice))
    cuts = np.flatnonzero(np.diff(at) > window) + 1
    return [(int(a[0]), int(a[-1]) + window) for a in np.split(at, cuts)]


def _numbered(words: list[bytes]) -> list[int]:
    numbers: dict[bytes, int] = {}
    return [numbers.setdefault(w, len(numbers)) for w in words]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(text: str, columns: list[str], min_words: int, min_exponent: int):
    window = -(-min_words * (min_exponent - 1) // min_exponent)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, text, 1 << 20):
            found, collapsed = [], []
            for value, hashes in zip(batch.column(text), Words(batch.column(text), UNSPACED, True).rows(), strict=True):
                raw = value.as_py()
                words = raw.encode().split() if raw else []  # of bytes, so at ASCII blanks
                mine = []
                for a, b in repeated_stretches(hashes, window):
                    mine += [(a + start, length, p) for start, length, p in Sequence(_numbered(words[a:b])).runs(min_words, min_exponent)]
                if mine:
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), mine)).tolist()]
                found.append([{"start": a, "length": b, "period": c} for a, b, c in mine])
                collapsed.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found, pa.list_(_RUN)), pa.array(collapsed, pa.string())], [*columns, "runs", "collapsed"])

    return run


@shipped
def periodic_runs(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, min_words: int = 24, min_exponent: int = 3) -> DataFrame:
    """The columns ``carry`` (doc_id), with ``runs`` (start, length, period) and ``collapsed``: the text without repeats.

    ``min_exponent`` is 3 or more.
    """
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods may hold no two whole roots")
    columns = ["doc_id"] if carry is None else carry
    rows = docs.select(*dict.fromkeys([*columns, text])).withColumn(text, F.col(text).cast("string"))
    run = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    schema = StructType([*(rows.schema[c] for c in columns), StructField("runs", ArrayType(run)), StructField("collapsed", StringType())])
    return rows.mapInArrow(_find(text, columns, min_words, min_exponent), schema)


def most_repeated(runs) -> "F.Column":
    """The run of the greatest exact exponent; of equal ones the first, then that of the shortest period."""
    better = lambda a, b: (b["length"] * a["period"] > a["length"] * b["period"])
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))


def repeated_tail(text, doc_id) -> "F.Column":
    """Every tenth document (by crc32 of its id) with a periodic tail; other texts as they are.

    With n words, g = crc32 div 10, a = g mod n and p = 1 + (n - a) div (3 + g mod 8), word i from a on becomes word
    a + (i - a) mod p.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n, g = F.size(words).cast("long"), F.floor(h / 10).cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    head = F.slice(words, F.lit(1), a.cast("int"))
    tail = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    looped = F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), (n - a).cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, looped), " ")).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of ``periodic_runs``."""
    best = most_repeated(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
