"""Token-ID / binary output: documents as token ids, compressed one by one with a shared zstandard dictionary.

File format of one shard (little endian)::

    b"FSTOK002"                                    magic
    header length, uint32; header, JSON            dictionary hash, id width, end id, documents, tokens, place of the shard
    one zstandard frame per document               ids as unsigned integers of the width
    index                                          per document: offset uint64, frame length uint32, n_tokens uint64,
                                                   doc_id int64, 1 if it has an id uint8
    index offset, uint64; b"FSTOKEND"              trailer

The dictionary lies beside the shards as ``dictionary-<sha256>.zdict``; a reader checks the hash before use.  A short
document is read with one seek: its index entry gives its frame.

Nulls and repeats: a null text counts as empty (only the end id); a null ``doc_id`` sorts first; rows with one doc_id, or
none, follow each other in the order of a hash of their frames and are cut into several ranges where they are many; equal
rows may swap unnoticed.  An empty table writes no shard.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import discard, open_fs, shared_dir, written

MAGIC, TAIL = b"FSTOK002", b"FSTOKEND"
_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u4"), ("n_tokens", "<u8"), ("doc_id", "<i8"), ("has_id", "u1")])
#: Distinct words that are looked up, and words of texts whose ids are put in a row, at one time.
_AT_ONCE = 1 << 15
#: The normaliser that the words' own way through the tokenizer stands for.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}


class WordTokenizer:
    """Ids of whole texts from the tokenizers library, batch by batch, with the ids of parts of words kept.

    The vocabulary's pre-tokenizer drops white space and never joins what stands on its two sides, so a text's ids are
    its words' ids in a row, and a batch's distinct words are enough.  Words in Latin-1 are cut by the tokenizer file's
    own pattern and go to the library's model directly; all others, and texts with special tokens or the control
    characters that Python alone splits at, go through the library's whole pipeline, as do all texts if the tokenizer
    file's normaliser or pre-tokenizer is another one than this way stands for.  At most ``keep`` parts are held.
    """

    def __init__(self, path: str, keep: int = 300_000):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # as the library pickles these steps; its text of the whole would bring the vocabulary along
        spec = {k: step and json.loads(step.__getstate__()) for k, step in (("normalizer", self.whole.normalizer), ("pre_tokenizer", self.whole.pre_tokenizer))}
        spec["model"] = {"type": type(self.model).__name__, "dropout": getattr(self.model, "dropout", None)}
        self.by_word = self._known(spec)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        if self.by_word:
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            self.pieces = regex.compile(rf"(?:{pattern})|\n").findall
        self.bytes = self._byte_level()
        tokenizer = self

        class Kept(dict):
            def __missing__(self, part: str) -> bytes:
                if len(self) >= keep:
                    self.clear()
                self[part] = ids = tokenizer.part(part)
                return ids

        self.parts = Kept()

    @staticmethod
    def _known(spec: dict) -> bool:
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if spec["normalizer"] != _NORMALIZER or spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            return False
        split, level = steps
        own = split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"] and r"\s" in split["pattern"]["Regex"]
        return own and not level["add_prefix_space"] and not level["use_regex"]

    @staticmethod
    def _byte_level() -> dict[int, str]:
        """The printable character that stands for each byte in byte-level vocabularies."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table = {b: chr(b) for b in plain}
        for b in range(256):
            if b not in table:
                table[b] = chr(256 + len(table) - len(plain))
        return table

    def pack(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def part(self, part: str) -> bytes:
        """Ids of a part; of the end of a word, a single byte, which no ids have as their length."""
        if part == "\n":
            return b"\n"
        shown = part if part.isascii() and part.isprintable() else "".join([self.bytes[b] for b in part.encode()])
        return self.pack([t.id for t in self.model.tokenize(shown)])

    def _through(self, text: str) -> bytes:
        return self.pack(self.whole.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as unsigned integers of ``width`` bytes; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, "|".join([r"[\x1c-\x1f]", *map(re.escape, self.special)])).to_numpy(zero_copy_only=False)
        if not self.by_word:
            return [self._through(t) for t in texts.to_pylist()]
        if odd.any():
            out = [self._through(t) if o else b"" for t, o in zip(texts.to_pylist(), odd, strict=True)]
            rest = np.flatnonzero(~odd)
            for k, ids in zip(rest.tolist(), self.encode_all(texts.take(pa.array(rest))), strict=True):
                out[k] = ids
            return out
        # white space here is that of str.split
        lists = pc.utf8_split_whitespace(texts)
        words = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        coded = lists.flatten().dictionary_encode()
        del lists, texts
        known = [self._words(coded.dictionary.slice(k, _AT_ONCE)) for k in range(0, max(len(coded.dictionary), 1), _AT_ONCE)]
        ids, length = (np.concatenate(x) for x in zip(*known, strict=True))
        first, codes = np.cumsum(length) - length, coded.indices.to_numpy()
        out, k = [], 0
        while k < len(words) - 1:
            stop = max(k + 1, int(np.searchsorted(words, words[k] + _AT_ONCE, "right")) - 1)
            code = codes[words[k] : words[stop]]
            many = length[code]
            ends = np.concatenate([[0], np.cumsum(many)])
            flat = ids[np.repeat(first[code] - ends[:-1], many) + np.arange(ends[-1])]
            cuts = ends[words[k : stop + 1] - words[k]].tolist()
            out += [flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            k = stop
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has."""
        if not len(words):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        wide = pc.match_substring_regex(words, r"[^\x{00}-\x{ff}]")
        far = {int(k): self._through(words[int(k)].as_py()) for k in np.flatnonzero(wide.to_numpy(zero_copy_only=False))}
        if far:
            words = pc.if_else(wide, "", words)
        line = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar("\n", pa.large_string()))[0].as_py() + "\n"
        found = list(map(self.parts.__getitem__, self.pieces(line.lower())))
        size = np.fromiter(map(len, found), np.int64, len(found))
        end = np.flatnonzero(size == 1)
        length = np.diff(np.cumsum(size // self.width)[end], prepend=0)
        raw = b"".join([x for x in found if len(x) != 1])
        if far:
            at = np.concatenate([[0], np.cumsum(length) * self.width]).tolist()
            raw = b"".join([far.get(k) or raw[at[k] : at[k + 1]] for k in range(len(words))])
            length[list(far)] = [len(x) // self.width for x in far.values()]
        return np.frombuffer(raw, self.kind), length


def train_dictionary(texts: list[str], tokenizer_path: str, size: int):
    """Zstandard dictionary of serialized ids; raw content where the sample is too small to train on."""
    import zstandard

    tokenizer = WordTokenizer(tokenizer_path)
    samples = [x for x in tokenizer.encode_all(pa.array(texts, pa.string())) if x]
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO) if data else None


def _compressor(tokenizer_path: str, dictionary: bytes, end_id: int, level: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from .words import batches, release

        release()
        tokenizer = WordTokenizer(tokenizer_path)
        zstd = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary), write_dict_id=False)
        end = tokenizer.pack([end_id])
        for batch in batches(it, "text"):
            ids = [x + end for x in tokenizer.encode_all(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // tokenizer.width for x in ids], pa.int64()), pa.array([zstd.compress(x) for x in ids], pa.binary())],
                ["doc_id", "n_tokens", "frame"],
            )
        # the worker lives on, and the parts refer to their tokenizer and it to them
        batch = ids = zstd = tokenizer = None
        release()

    return run


def _shard_writer(folder: str, width: int, end_id: int, sha: str, most: int):
    """Writes a partition's frames, in order, as shards of about ``most`` bytes, under names no other attempt uses."""

    def close(fs, path: str, place: tuple[int, int], frames: list[bytes], tokens: list[int], ids: list[int | None]) -> int:
        head = json.dumps({"dictionary": sha, "width": width, "end_id": end_id, "documents": len(frames), "tokens": sum(tokens), "place": place}).encode()
        index = np.zeros(len(frames), _ENTRY)
        index["length"], index["n_tokens"] = [len(x) for x in frames], tokens
        index["doc_id"], index["has_id"] = [i or 0 for i in ids], [i is not None for i in ids]
        start, size = len(MAGIC) + 4 + len(head), int(index["length"].sum(dtype=np.int64))
        index["offset"] = start + np.concatenate([[0], np.cumsum(index["length"][:-1], dtype=np.uint64)])
        with fs.open_output_stream(path + ".part", buffer_size=1 << 20) as out:
            for x in (MAGIC, struct.pack("<I", len(head)), head, *frames, index.tobytes(), struct.pack("<Q", start + size), TAIL):
                out.write(x)
        fs.move(path + ".part", path)
        return start + size + index.nbytes + 16

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .words import batches, release

        fs, root = open_fs(folder)
        part, seq = TaskContext.get().partitionId(), 0
        frames: list[bytes] = []
        tokens: list[int] = []
        ids: list[int | None] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq
            name = f"shard-{part:06d}-{seq:05d}-{uuid.uuid4().hex[:12]}.fstok"
            size = close(fs, f"{root}/{name}", (part, seq), frames, tokens, ids)
            row = {"part": part, "seq": seq, "file": name, "bytes": size, "documents": len(frames), "tokens": sum(tokens)}
            seq += 1
            for x in (frames, tokens, ids):
                x.clear()
            return pa.RecordBatch.from_pylist([row], _MANIFEST)

        held = 0
        for batch in batches(it, "frame", 1 << 20):
            for i, n, x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame")), strict=True):
                frames.append(x)
                tokens.append(n)
                ids.append(i)
                held += len(x)
                if held >= most:
                    yield flush()
                    held = 0
        if frames:
            yield flush()
        batch = x = None
        release()

    return run


_MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("bytes", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64())])
_MANIFEST_DDL = "part int, seq int, file string, bytes long, documents long, tokens long"


def _header(file, path: str) -> dict:
    file.seek(0)
    magic, n = struct.unpack("<8sI", file.read(12))
    if magic != MAGIC:
        raise ValueError(f"{path} is not a token shard")
    return json.loads(file.read(n))


class Shard:
    """Random access to one shard through its index."""

    def __init__(self, fs, path: str, dictionary: bytes):
        import zstandard

        self.file = fs.open_input_file(path)
        self.header, size = _header(self.file, path), self.file.size()
        self.file.seek(size - 16)
        at, tail = struct.unpack("<Q8s", self.file.read(16))
        if tail != TAIL:
            raise ValueError(f"{path} is not a whole token shard")
        if self.header["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError(f"{path} was written with another dictionary")
        self.file.seek(at)
        self.index = np.frombuffer(self.file.read(size - 16 - at), _ENTRY)
        self.zstd = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def doc_ids(self, a: int, b: int) -> pa.Array:
        """Ids of the documents ``a`` to ``b``, null where they have none."""
        some = self.index[a:b]
        return pa.array(some["doc_id"].astype(np.int64), mask=some["has_id"] == 0)

    def __getitem__(self, k: int) -> np.ndarray:
        entry = self.index[k]
        self.file.seek(int(entry["offset"]))
        width = self.header["width"]
        raw = self.zstd.decompress(self.file.read(int(entry["length"])), max_output_size=int(entry["n_tokens"]) * width)
        return np.frombuffer(raw, f"<u{width}")


@shipped
def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = 2, dictionary_bytes: int = 65_536, sample_rows: int = 1_024, sample_chars: int = 8_192, level: int = 3, shard_bytes: int = 16 << 20) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder`` in ascending doc_id order; returns the manifest of the shards.

    The dictionary is trained on pieces of at most ``sample_chars`` characters from ``sample_rows`` documents, chosen by
    a hash of the id; that bounded sample only sets the compression, all documents are written whole.  Frames are
    stored once before the range partitioning, so that finding the ranges does not tokenize anything twice.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    middle = F.greatest(F.lit(1), (F.length("text") / 2 - sample_chars // 2).cast("int"))
    pieces = docs.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi").select(F.substring(F.col("text"), middle, F.lit(sample_chars)).alias("t")).limit(2 * sample_rows)
    texts = sorted(r.t for r in pieces.collect() if r.t)
    dictionary = train_dictionary(texts, tokenizer_path, dictionary_bytes)
    sha = hashlib.sha256(dictionary).hexdigest()
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary-{sha}.zdict") as out:
        out.write(dictionary)
    width = WordTokenizer(tokenizer_path).width
    frames = docs.mapInArrow(_compressor(tokenizer_path, dictionary, end_id, level), "doc_id long, n_tokens long, frame binary")
    frames = written(frames.withColumn("size", F.octet_length("frame")), f"{folder}/frames")
    # the hash and the row's number part the ranges of rows with one id; equal rows are interchangeable
    spread = frames.withColumns({"spread": F.xxhash64("frame"), "number": F.monotonically_increasing_id()})
    ranges = max(1, -(-(frames.agg(F.sum("size")).first()[0] or 0) // shard_bytes))
    ordered = spread.repartitionByRange(ranges, "doc_id", "spread", "number").sortWithinPartitions("doc_id", "spread", "frame")
    manifest = ordered.select("doc_id", "n_tokens", "frame").mapInArrow(_shard_writer(folder, width, end_id, sha, shard_bytes), _MANIFEST_DDL)
    out = written(manifest, f"{folder}/manifest")
    discard(spark, f"{folder}/frames")
    return out


@shipped
def read_tokens(spark, folder: str, dictionary_sha: str | None = None, *, task_bytes: int = 8 << 20) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the files that the manifest below ``folder`` names.

    Everything but the names of the files comes from the files: ``start`` counts the ids of all documents before, which
    are the totals in the headers of the shards before (a row per shard) and what stands before it in its shard's index.
    There is a task for each ``task_bytes`` of files: an explicit number, as adaptive execution would see only names.
    """
    fs, root = open_fs(folder)
    from pyarrow.fs import FileSelector

    names = [x.base_name for x in fs.get_file_info(FileSelector(root)) if x.base_name.startswith("dictionary-")]
    name = next(x for x in names if not dictionary_sha or dictionary_sha in x)
    with fs.open_input_stream(f"{root}/{name}") as f:
        dictionary = f.read()
    manifest = spark.read.schema(_MANIFEST_DDL).parquet(f"{folder}/manifest")
    tasks = -(-(manifest.agg(F.sum("bytes")).first()[0] or 1) // task_bytes)

    def headers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in it:
            rows = []
            for file in batch.column("file").to_pylist():
                with fs.open_input_file(f"{root}/{file}") as f:
                    head = _header(f, file)
                rows.append((file, *head["place"], head["tokens"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["file", "part", "seq", "tokens"])

    heads = manifest.select("file").repartition(-(-tasks // 16)).mapInArrow(headers, "file string, part long, seq long, tokens long")
    before = F.sum("tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    todo = heads.select("file", F.coalesce(before, F.lit(0)).alias("start")).repartition(tasks)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import release

        fs, root = open_fs(folder)
        for batch in it:
            for row in batch.to_pylist():
                shard, start = Shard(fs, f"{root}/{row['file']}", dictionary), row["start"]
                for k in range(0, len(shard), 256):
                    ids = [shard[j] for j in range(k, min(k + 256, len(shard)))]
                    n = np.array([len(x) for x in ids], np.int64)
                    firsts = start + np.concatenate([[0], np.cumsum(n[:-1])])
                    start += int(n.sum())
                    yield pa.RecordBatch.from_arrays([shard.doc_ids(k, k + 256), pa.array(firsts, pa.int64()), pa.array(n, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
        shard = ids = n = firsts = None
        release()

    return todo.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write ``docs`` to a new folder of the shared store and read the files back: (doc_id, start, n_tokens, ids)."""
    folder = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer_path, **options)
    return read_tokens(docs.sparkSession, folder)


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows from ``read_tokens``; ``ids`` are unsigned 32-bit, little endian."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc_of(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
