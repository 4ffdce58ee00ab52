"""Vectorised words of Arrow text columns: 64-bit hashes without a Python object per word.

A word is a maximal run of ASCII letters, digits and bytes of non-ASCII characters in the lower-cased text, so
case, punctuation and white space don't count; other bytes can be given, and lower-casing of A to Z alone.  The hash is a polynomial over the word's bytes modulo 2**64,
mixed at the end; it is computed from prefix sums, in blocks of about a megabyte cut between words.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 19


def bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that marks the bytes from a to below b of each range."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b] = True
    return table


#: Bytes of words: letters, digits and non-ASCII characters; or all but ASCII blanks.
_WORD = bytes_in((48, 58), (97, 123), (128, 256))
UNSPACED = ~bytes_in((9, 14), (32, 33))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n - 1, 1).bit_length()
    if size not in _POWERS:
        _POWERS.clear()
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[size] = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, inverse))
    return _POWERS[size]


class Words:
    """Words of a text column: ``hashes``, ``starts`` and ``ends`` in bytes of ``data``, ``offsets`` per row."""

    def __init__(self, texts: pa.Array, inside: np.ndarray = _WORD, ascii_only: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        member = inside
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not ascii_only:
            texts = pc.utf8_lower(texts)
        limits = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[limits[0] : limits[-1]] if len(texts) else np.zeros(0, np.uint8)
        limits = limits - limits[0] if len(texts) else np.zeros(1, np.int64)
        if ascii_only:
            # Arrow's own ascii_lower goes wrong on slices
            data = _LOWER[data]
        self.data, self.limits = data, limits
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = member[data]
        first = inside[1:-1] & ~inside[:-2]
        last = inside[1:-1] & ~inside[2:]
        cuts = limits[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts] = inside[1:-1][cuts]
        last[cuts - 1] = inside[1:-1][cuts - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.offsets = np.searchsorted(self.starts, limits)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        out, k = np.empty(len(self.starts), np.uint64), 0
        while k < len(self.starts):
            base = self.starts[k]
            stop = max(k + 1, int(np.searchsorted(self.ends, base + _BLOCK, "right")))
            s, e = self.starts[k:stop] - base, self.ends[k:stop] - base
            power, inverse = _powers(int(e[-1]))
            block = self.data[base : base + e[-1]].astype(np.uint64)
            block += np.uint64(1)
            block *= power[: len(block)]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(block, dtype=np.uint64)])
            out[k:stop] = (total[e] - total[s]) * inverse[s]
            k = stop
        return mix(out)

    def rows(self) -> Iterator[np.ndarray]:
        for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True):
            yield self.hashes[a:b]


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of every ``size`` words that follow each other; one hash for all words of a shorter row."""
    n = len(hashes)
    size = min(size, n)
    out = np.zeros(max(n - size + 1, 0) if n else 0, np.uint64)
    for k in range(size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k : n - size + 1 + k]
    return mix(out)


def batches(it: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most about ``most`` bytes of text, one row at least."""
    for batch in it:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, k = np.cumsum(size), 0
        while k < len(size):
            before = total[k] - size[k]
            stop = max(k + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(k, stop - k)
            k = stop
    release()


def release() -> None:
    """Give freed memory back at the end of a partition: workers live on for other tasks.

    Caches and tokenizers of earlier tasks may be in reference cycles, which the collector would leave for long, as what
    they hold are mostly strings.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
