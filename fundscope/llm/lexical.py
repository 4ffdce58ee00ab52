"""Ranked lexical search over an impact-ordered index, score at a time.

Terms are runs of letters, digits and non-ASCII characters of the whole text, A to Z lower-cased; they are told apart by
64-bit hashes.  The index keeps, for each document, its number of terms and the occurrences of those terms that some item
asks for.  With the counts over all documents (N with a term, L terms, df per term) a posting's impact is an integer,
``weight * (1000000000 * tf div (1000 * tf + 12 * m))`` with m = 75 + 25 * n * N div L and weight =
floor(1000 * ln((2 N + 2) / (2 df + 1))).

The documents of a task form shards of about ``postings`` postings.  In a shard each term's postings stand by descending
exact impact.  An item's search takes postings of all its terms in levels of falling impact and adds them up;
what a document can still gain is at most the sum of its terms' next impacts.  Once no more than ``few`` documents of the
shard can still reach the k-th best sum, the scores of just those are completed from their postings and ranked.  Shards
give k rows an item, of which the best k remain.  All sums are of 64-bit integers, so stopping early changes nothing.

Items are searched in blocks whose terms fit in ``block_terms``, so what tasks hold of the items is bounded; the documents
are read and counted once for each block.

Nulls and repeats: a null text, or one without terms, is no document of N and never found; an item without terms, with a
null text or with terms that no document has finds nothing; items that share an id, null included, are one item with all
their terms; a repeated document is found as often as it stands there, and equal ids rank by their place; a null doc_id ranks after all others of its score.  An empty table gives no rows.  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import Cells, put_cells, shared_dir, with_row_key, written
from .words import Words, batches, release

_FOUND = "item long, row long, doc_id long, score long"


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def _item_terms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, term, times) of each item."""
    for batch in batches(it, "text"):
        words = Words(batch.column("text"), ascii_only=True)
        item = np.repeat(batch.column("item").to_numpy(), np.diff(words.offsets))
        pairs, times = np.unique(np.stack([item, words.hashes.view(np.int64)], 1), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(times, pa.int64())], ["item", "term", "times"])


def _counts(folder: str):
    """(row, doc_id, n, terms, tfs): the document's number of terms, and its occurrences of the block's terms."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Cells(folder)[(0,)]
        known = table.column("term").to_numpy() if table is not None else np.zeros(0, np.int64)
        for batch in batches(it, "text"):
            words = Words(batch.column("text"), ascii_only=True)
            n = np.diff(words.offsets)
            doc, h = np.repeat(np.arange(len(n)), n), words.hashes.view(np.int64)
            place = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            asked = np.flatnonzero(known[place] == h) if len(known) else np.zeros(0, np.int64)
            code, tf = np.unique(doc[asked] * len(known) + place[asked], return_counts=True)
            per = np.bincount(code // max(len(known), 1), minlength=len(n)) if len(code) else np.zeros(len(n), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64()), _lists(code % max(len(known), 1), per, pa.int32()), _lists(tf, per, pa.int64())],
                ["row", "doc_id", "n", "terms", "tfs"],
            )

    return run


class _Shard:
    """Postings of some documents, by term and descending impact."""

    def __init__(self, rows: list[pa.RecordBatch], weight: np.ndarray, total: int, length: int):
        table = pa.Table.from_batches(rows)
        lists = table.column("terms").combine_chunks()
        self.row, n = (table.column(c).to_numpy() for c in ("row", "n"))
        self.doc_id = table.column("doc_id").combine_chunks()
        doc = np.repeat(np.arange(len(n)), pc.list_value_length(lists).to_numpy())
        term, tf = lists.flatten().to_numpy().astype(np.int64), table.column("tfs").combine_chunks().flatten().to_numpy()
        m = 75 + 25 * n * total // max(length, 1)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
        self.forward = np.searchsorted(doc, np.arange(len(n) + 1)), term, impact  # by document, terms ascending
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.falling = -self.impact
        self.cuts = np.searchsorted(term[order], np.arange(len(weight) + 1))

    def complete(self, docs: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Whole scores of some documents."""
        cuts, term, impact = self.forward
        out = np.zeros(len(docs), np.int64)
        for k, d in enumerate(docs.tolist()):
            mine = slice(cuts[d], cuts[d + 1])
            at = np.minimum(np.searchsorted(terms, term[mine]), len(terms) - 1)
            out[k] = (impact[mine] * times[at])[terms[at] == term[mine]].sum()
        return out

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, few: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, postings read) of all documents that may be among the k best; ``terms`` ascend."""
        lists = [(self.cuts[t], self.cuts[t + 1], q) for t, q in zip(terms.tolist(), times.tolist(), strict=True)]
        lists = [(a, b, q) for a, b, q in lists if a < b and self.impact[a] > 0]
        sums, at, read = np.zeros(len(self.row), np.int64), [a for a, _, _ in lists], 0
        while True:
            # the most that the next posting of each term can give
            bounds = [int(self.impact[x]) * q if x < b else 0 for x, (_, b, q) in zip(at, lists, strict=True)]
            rest, top = sum(bounds), max(bounds, default=0)
            best = np.partition(sums, -k)[-k] if len(sums) >= k else 0
            # not even all that is left lifts a document below this to the k-th best
            able = np.flatnonzero(sums + rest >= max(best, 1))
            if not top:
                return able, sums[able], read
            if best and len(able) <= few:
                return able, self.complete(able, terms, times), read
            level = top * 2 // 3
            for x, (_, b, q) in enumerate(lists):
                if bounds[x] > level:
                    # all postings of the term with an impact above the level; those of equal impact stay together
                    stop = at[x] + int(np.searchsorted(self.falling[at[x] : b], -(level // q), "left"))
                    sums[self.doc[at[x] : stop]] += self.impact[at[x] : stop] * q
                    read += stop - at[x]
                    at[x] = stop


def _searched(folder: str, total: int, length: int, k: int, postings: int, few: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(folder)
        known, asked = cells[(0,)], cells[(1,)]
        if known is None:
            return
        weight = known.column("weight").to_numpy()
        item, place, times = (asked.column(c).to_numpy() for c in ("item", "place", "times"))
        cuts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]]))
        items = [(int(item[a]), place[a:b], times[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

        def found(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = _Shard(rows, weight, total, length)
            out = []
            for i, terms, n in items:
                docs, score, _ = shard.search(terms, n, k, few)
                docs, score = docs[score > 0], score[score > 0]
                if len(docs):
                    ids = shard.doc_id.take(pa.array(docs))
                    order = np.lexsort((shard.row[docs], pc.fill_null(ids, 2**63 - 1).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), -score))[:k]
                    out.append((np.full(len(order), i, np.int64), shard.row[docs[order]], ids.take(pa.array(order)), score[order]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[0] for o in out])), pa.array(np.concatenate([o[1] for o in out])), pa.concat_arrays([o[2] for o in out]), pa.array(np.concatenate([o[3] for o in out]))], ["item", "row", "doc_id", "score"])

        held, size = [], 0
        for batch in it:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                held.append(part)
                size += len(part.column("terms").flatten())
                if size >= postings:
                    yield from found(held)
                    held, size = [], 0
        if held:
            yield from found(held)
        release()

    return run


@shipped
def search(docs: DataFrame, items: DataFrame, *, k: int = 20, block_terms: int = 1 << 20, postings: int = 1 << 21, few: int = 200) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) for each item (item_id, text)."""
    spark = docs.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    ids = with_row_key(written(items.select(F.col("item_id").alias("id")).distinct(), shared_dir(spark, "items")), "item")
    numbered = items.join(ids, F.col("item_id").eqNullSafe(F.col("id"))).select("item", "text")
    asked = numbered.mapInArrow(_item_terms, "item long, term long, times long").groupBy("item", "term").agg(F.sum("times").alias("times"))
    asked = written(asked, shared_dir(spark, "item-terms"))
    n_terms = asked.count()
    blocks = max(1, -(-n_terms // block_terms))
    docs = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "row")
    found = None
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else asked
        part = _block(docs, mine, k, postings, few)
        found = part if found is None else found.unionByName(part)
    found = written(found, shared_dir(spark, "found"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(ids, "item").select(F.col("id").alias("item_id"), "rank", "doc_id", "score")


def _block(docs: DataFrame, asked: DataFrame, k: int, postings: int, few: int) -> DataFrame:
    """The best rows of every shard for the items of one block."""
    spark = docs.sparkSession
    vocabulary = asked.select("term").distinct()
    folder = shared_dir(spark, "vocabulary")
    put_cells(vocabulary.withColumn("cell", F.lit(0)), ["cell"], ["term"], folder)
    counted = written(docs.mapInArrow(_counts(folder), "row long, doc_id long, n long, terms array<int>, tfs array<long>"), shared_dir(spark, "index"))
    total, length = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # places of terms among the sorted ones, as the index has them
    df = counted.select(F.explode("terms").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("df"))
    numbered = vocabulary.withColumn("place", F.row_number().over(Window.orderBy("term")) - 1)
    weight = F.floor(1000 * F.log((2 * total + 2) / (2 * F.coalesce(F.col("df"), F.lit(0)) + 1))).cast("long")
    known = written(numbered.join(df, "place", "left").select("place", "term", weight.alias("weight")), shared_dir(spark, "weights"))
    side = known.select(F.lit(0).alias("cell"), F.lit(None).cast("long").alias("item"), "place", "weight", F.lit(None).cast("long").alias("times"))
    side = side.unionByName(asked.join(known, "term").select(F.lit(1).alias("cell"), "item", "place", F.lit(None).cast("long").alias("weight"), "times"))
    index = shared_dir(spark, "weighted")
    put_cells(side, ["cell"], ["item", "place"], index)
    return counted.filter("size(terms) > 0").mapInArrow(_searched(index, total, length, k, postings, few), _FOUND)
