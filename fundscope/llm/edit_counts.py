"""Edit-aware token counts: a segment tree over each document's pre-tokens, kept, and updated where edits touch it.

A byte-level BPE cuts a text into pre-tokens by a pattern and encodes each on its own, so a text's count is the sum over
its pre-tokens.  A document's tree has chunks of pre-tokens with their counts as leaves, and sums of characters and
tokens above.  An edit finds its leaves by descending on characters, cuts the text anew from a few pre-tokens before
the edit until the cuts fall on old ones again after it, counts only those pre-tokens, and updates the sums on the way
up.

``plant`` gives a table with a tree per document, to be stored; ``edit`` takes such a table and edits to the trees after
them.  A stored tree is its text, the lengths of its pre-tokens and their counts: reading it back cuts and encodes
nothing, and the sums above the leaves are added up again only where a document has edits.

Nulls and repeats: a null text counts as empty, with 0 tokens; an edit outside the text is clipped to it; edits apply in
order, each to the text that the ones before have left; a null list of edits is empty; a repeated document is counted
each time, and a null id is kept.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped

CHUNK = 64
#: Pre-tokens before an edit that are cut again: a pattern's lookahead and contractions reach no further back.
CONTEXT = 2
_EDITS = "array<struct<begin:int,end:int,text:string>>"


class Counter:
    """Pre-tokens of a text and their numbers of tokens, with counts of pre-tokens kept up to a bound."""

    def __init__(self, ranks_path: str, pattern: str, keep: int = 500_000):
        import base64

        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        encoding = self.encoding

        class Kept(dict):
            def __missing__(self, piece: str) -> int:
                if len(self) >= keep:
                    self.clear()
                self[piece] = n = len(encoding.encode_ordinary(piece))
                return n

        self.known = Kept()

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, piece: str) -> int:
        return self.known[piece]


class Tree:
    """A document as a segment tree over chunks of its pre-tokens.

    ``leaves[k]`` is (pre-tokens, counts); nodes are numbered as in a heap, and ``chars`` and ``tokens`` hold their sums.
    The text is nowhere kept as a whole, so that an edit costs its own region and a path to the root.
    """

    def __init__(self, text: str, counter: Counter, lengths: list[int] | None = None, counts: list[int] | None = None):
        """From a text, or from a stored tree's text, lengths and counts, where nothing is cut or encoded."""
        self.counter, self.encoded = counter, 0
        if lengths is None:
            pieces = counter.pieces(text)
            counts = list(map(counter.known.__getitem__, pieces))
        else:
            ends = np.cumsum(lengths).tolist()
            pieces = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
        self._build(self._chunks(pieces, counts))

    @staticmethod
    def _chunks(pieces: list[str], counts: list[int]) -> list[tuple[list[str], list[int]]]:
        return [(pieces[k : k + CHUNK], counts[k : k + CHUNK]) for k in range(0, len(pieces), CHUNK)]

    def _build(self, leaves: list[tuple[list[str], list[int]]]) -> None:
        self.leaves = leaves or [([], [])]
        self.size = 1 << max(0, len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, (pieces, counts) in enumerate(self.leaves):
            self.chars[self.size + k], self.tokens[self.size + k] = sum(map(len, pieces)), sum(counts)
        for k in range(self.size - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(p for pieces, _ in self.leaves for p in pieces)

    def find(self, char: int) -> tuple[int, int]:
        """(leaf, first character of it) that holds the character, the last leaf with characters for the end."""
        node, start = 1, 0
        char = min(char, max(0, self.chars[1] - 1))
        while node < self.size:
            left = self.chars[2 * node]
            node, start, char = (2 * node, start, char) if char < left else (2 * node + 1, start + left, char - left)
        return min(node - self.size, len(self.leaves) - 1), start

    def _set(self, k: int, leaf: tuple[list[str], list[int]]) -> None:
        self.leaves[k] = leaf
        node = self.size + k
        self.chars[node], self.tokens[node] = sum(map(len, leaf[0])), sum(leaf[1])
        while node > 1:
            node //= 2
            self._sum(node)

    def _before(self, at: int) -> tuple[int, int, int]:
        """(leaf, place in it, first character) of the pre-token ``CONTEXT`` before the one with character ``at``."""
        k, here = self.find(at)
        place, pieces = 0, self.leaves[k][0]
        while place < len(pieces) and here + len(pieces[place]) <= at:
            here += len(pieces[place])
            place += 1
        for _ in range(CONTEXT):
            while place == 0 and k > 0:
                k -= 1
                place = len(self.leaves[k][0])
            if place:
                place -= 1
                here -= len(self.leaves[k][0][place])
        return k, place, here

    def edit(self, begin: int, end: int, new: str) -> None:
        """Replace the characters from ``begin`` to ``end`` by ``new``."""
        begin = min(max(begin, 0), self.chars[1])
        end = min(max(end, begin), self.chars[1])
        first, place, start = self._before(begin)
        last, more = max(first, self.find(end)[0]), 1
        while True:
            old = [p for k in range(first, last + 1) for p in self.leaves[k][0][place if k == first else 0 :]]
            done, kept = self._cut(old, begin - start, end - start, new, last + 1 == len(self.leaves))
            if done is not None:
                break
            last, more = min(last + more, len(self.leaves) - 1), 2 * more
        counts = [self.counter.count(p) for p in done]
        self.encoded += sum(map(len, done))
        known = [n for k in range(first, last + 1) for n in self.leaves[k][1][place if k == first else 0 :]]
        head = self.leaves[first]
        pieces = [*head[0][:place], *done, *old[kept:]]
        counts = [*head[1][:place], *counts, *known[kept:]]
        span = last - first + 1
        if len(pieces) > 4 * CHUNK * span:
            self._build([*self.leaves[:first], *self._chunks(pieces, counts), *self.leaves[last + 1 :]])
            return
        each = -(-len(pieces) // span)
        for j in range(span):
            self._set(first + j, (pieces[j * each : (j + 1) * each], counts[j * each : (j + 1) * each]))

    def _cut(self, old: list[str], begin: int, end: int, new: str, to_end: bool) -> tuple[list[str] | None, int]:
        """(new pre-tokens, number of old ones they replace); none if the cuts don't meet within these old ones.

        From where a new cut falls on an old one behind the edit, both texts are the same, and so are all further cuts.
        A cut at the end of what was read may be there only because the reading ends.
        """
        text = "".join(old)
        text, shift = text[:begin] + new + text[end:], len(new) - (end - begin)
        done, at, k = [], 0, 0
        for m in self.counter.pattern.finditer(text):
            done.append(m.group())
            if m.end() > begin + len(new) and m.end() < len(text):
                while at < m.end() - shift:
                    at += len(old[k])
                    k += 1
                if at == m.end() - shift and at >= end:
                    return done, k
        return (done, len(old)) if to_end else (None, 0)


_TREE = "doc_id long, text string, lengths binary, counts binary, tokens long"
_EDITED = ("n_edits", "tokens_before", "chars_after", "chars_encoded")


def _packed(numbers) -> bytes:
    """Numbers in as few bytes each as the largest needs, told by the first byte."""
    x = np.asarray(numbers, np.uint32)
    width = 1 if not len(x) or x.max() < 1 << 8 else 2 if x.max() < 1 << 16 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> list[int]:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).tolist()


def _grown(text: str, lengths: bytes | None, counts: bytes | None, tokens: int, edits: list[dict], counter: Counter) -> tuple:
    """A stored tree, or a text without one, after its edits: (text, lengths, counts, tokens), then what the edits did."""
    if not edits:
        if lengths is None:
            pieces = counter.pieces(text)
            known = list(map(counter.known.__getitem__, pieces))
            lengths, counts, tokens = _packed(list(map(len, pieces))), _packed(known), sum(known)
        return text, lengths, counts, tokens, 0, tokens, len(text), 0
    tree = Tree(text, counter) if lengths is None else Tree(text, counter, _unpacked(lengths), _unpacked(counts))
    before = tree.total
    for e in edits:
        tree.edit(e["begin"], e["end"], e["text"] or "")
    text = tree.text
    lengths, counts = _packed([len(p) for pieces, _ in tree.leaves for p in pieces]), _packed([n for _, known in tree.leaves for n in known])
    return text, lengths, counts, tree.total, len(edits), before, len(text), tree.encoded


def _mapped(table: DataFrame, ranks_path: str, pattern: str, find: Callable[[str], list[dict]] | None, stored: bool, carry: dict[str, str]) -> DataFrame:
    edits = F.col("edits").cast(_EDITS) if not find and "edits" in table.columns else F.lit(None).cast(_EDITS)
    own = ["lengths", "counts", "tokens"] if stored else [F.lit(None).cast("binary").alias("lengths"), F.lit(None).cast("binary").alias("counts"), F.lit(0).cast("long").alias("tokens")]
    kept = [F.col(c).cast(t).alias(c) for c, t in carry.items()]
    table = table.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *own, edits.alias("edits"), *kept)
    kinds = (pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 5)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import batches

        counter = Counter(ranks_path, pattern)
        for batch in batches(it, "text"):
            given = zip(*(batch.column(c).to_pylist() for c in ("text", "lengths", "counts", "tokens", "edits")), strict=True)
            rows = [_grown(text, lengths, counts, tokens, find(text) if find else e or [], counter) for text, lengths, counts, tokens, e in given]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols, *(batch.column(c) for c in carry)], ["doc_id", "text", "lengths", "counts", "tokens", *_EDITED, *carry])

    return table.mapInArrow(run, ", ".join([_TREE, *(f"{c} long" for c in _EDITED), *(f"{c} {t}" for c, t in carry.items())]))


@shipped
def plant(docs: DataFrame, ranks_path: str, pattern: str, find: Callable[[str], list[dict]] | None = None, carry: dict[str, str] | None = None) -> DataFrame:
    """A tree per document, (doc_id, text, lengths, counts, tokens), and what its first edits did.

    Edits are the column ``edits``, array<struct<begin, end, text>> in characters, if there is one; instead, ``find`` may
    give a text's edits.  Beside the tree after them come n_edits, tokens_before, chars_after and chars_encoded, the
    characters that the edits had encoded anew, and the columns (name to type) that ``carry`` asks for.  Nothing is
    shuffled.
    """
    return _mapped(docs, ranks_path, pattern, find, False, carry or {})


@shipped
def edit(trees: DataFrame, ranks_path: str, pattern: str, find: Callable[[str], list[dict]] | None = None, carry: dict[str, str] | None = None) -> DataFrame:
    """Stored ``trees`` after further edits, in the columns of ``plant``; trees without edits pass as they are."""
    return _mapped(trees, ranks_path, pattern, find, True, carry or {})


@shipped
def counts_with_edits(docs: DataFrame, ranks_path: str, pattern: str, find: Callable[[str], list[dict]] | None = None) -> DataFrame:
    """(doc_id, n_edits, tokens_before, tokens_after, chars_after, chars_encoded) of rows (doc_id, text, edits)."""
    return plant(docs, ranks_path, pattern, find).select("doc_id", "n_edits", "tokens_before", F.col("tokens").alias("tokens_after"), "chars_after", "chars_encoded")


#: Personal data that the redaction edits replace: mail addresses, IPv4 addresses, long digit runs of cards and phones.
REDACTED = re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+\.[\w.-]+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{12,19}\b")


#: Web addresses that a second batch of edits replaces.
LINKS = re.compile(r"\bhttps?://[^\s<>\"']+")


def _replaced(pattern: re.Pattern, text: str, mark: str) -> list[dict]:
    """Edits that replace each match by ``mark``, each in characters of the text that the others have left."""
    out, shift = [], 0
    for m in pattern.finditer(text):
        out.append({"begin": m.start() + shift, "end": m.end() + shift, "text": mark})
        shift += len(mark) - (m.end() - m.start())
    return out


def redactions(text: str, mark: str = "[redacted]") -> list[dict]:
    """Edits that replace personal data."""
    return _replaced(REDACTED, text, mark)


def unlinked(text: str, mark: str = "[link]") -> list[dict]:
    """Edits that replace web addresses."""
    return _replaced(LINKS, text, mark)
