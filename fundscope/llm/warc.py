"""WARC files: written with an index (offset, length, URL, digest), read back by coalesced byte ranges.

Every record is a gzip member of its own, so that a record is readable from its offset and length alone.  A payload of
at least ``min_bytes`` that occurs more than once is stored once, by the row with the largest page_id; the others become
revisit records, whose HTTP header still tells the full payload's length and whose WARC-Payload-Digest its digest.

Which rows are revisits is decided on (digest, page_id) of the payloads that are long enough; the rows learn it by their
places in the files, so no payload is ever shuffled.  A record's id is its page's, followed by its row's place.

Nulls and repeats: a null html is an empty payload; a null or empty url is written as ``urn:page:<id>`` and read back as
that; line ends in a url are written, and read back, as %0D and %0A; rows that repeat both the largest page_id and its
payload are all responses, and revisits refer to the first of them; rows with a null page_id refer to the response like
all others, and are responses where no row with that payload has an id.  An empty table gives no archive and no rows.
Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import shipped
from .common import Places, open_fs, shared_dir, spread_join, with_row_key, written
from .words import release

_DATE = "2024-01-01T00:00:00Z"
_INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
_INDEX_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string())])
_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def revisits(payloads: DataFrame) -> DataFrame:
    """(row, refers_to, refers_row) of the rows of (row, page_id, digest) that revisit the response of their digest."""
    winners = payloads.groupBy("digest").agg(F.max(F.struct("page_id", -F.col("row"))).alias("first"), F.count(F.lit(1)).alias("copies"))
    winners = winners.filter("copies > 1 and first.page_id is not null").select("digest", "copies", F.col("first.page_id").alias("refers_to"), (-F.col("first.col2")).alias("refers_row"))
    winners = written(winners, shared_dir(payloads.sparkSession, "winners"))
    return spread_join(payloads, winners, "digest", "copies").filter("not page_id <=> refers_to").select("row", "refers_to", "refers_row")


def _record(row: int, page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple[int, int] | None) -> bytes:
    name = lambda page, row: f"<urn:page:{'' if page is None else page}:row:{row}>"
    kind = "response" if refers is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers is None else b"")
    target = (url or f"urn:page:{'' if page_id is None else page_id}").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id, row)}", f"WARC-Target-URI: {target}", f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(*refers)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, decided: str, most: int, level: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        side = Places(decided)
        out, name, at, rows = None, "", 0, []

        def close() -> None:
            out.close()
            fs.move(f"{root}/{name}.part", f"{root}/{name}")

        for batch in it:
            if not batch.num_rows:
                continue
            refers: dict[int, tuple[int, int]] = {}
            for mine, table in side.matches(batch.column("row").to_numpy(), "row"):
                refers |= dict(zip(mine.tolist(), zip(table.column("refers_to").to_pylist(), table.column("refers_row").to_pylist(), strict=True), strict=True))
            for k, (row, page_id, url, html) in enumerate(zip(*(batch.column(c) for c in ("row", "page_id", "url", "html")), strict=True)):
                row, page_id, url, payload = row.as_py(), page_id.as_py(), url.as_py(), (html.as_py() or "").encode()
                if out is None:
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}.part", compression=None)
                digest, other = hashlib.sha1(payload).hexdigest(), refers.get(k)
                member = gzip.compress(_record(row, page_id, url, payload, digest, other), level, mtime=0)
                out.write(member)
                rows.append({"file": name, "offset": at, "length": len(member), "page_id": page_id, "url": url, "payload_digest": digest, "record_type": "response" if other is None else "revisit"})
                at += len(member)
                if at >= most:
                    close()
                    out = None
            yield pa.RecordBatch.from_pylist(rows, _INDEX_ARROW)
            rows = []
        if out is not None:
            close()
        release()

    return run


@shipped
def write_warc(pages: DataFrame, folder: str, *, min_bytes: int = 1000, file_bytes: int = 256 << 20, level: int = 4) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder``; returns the index, stored beside them.

    A task that is run again writes files of other names; the index names only those of the attempt that counted.
    """
    spark = pages.sparkSession
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    pages = with_row_key(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")), "row")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    long = written(pages.filter(F.octet_length(payload) >= min_bytes).select("row", "page_id", F.sha1(payload).alias("digest")), shared_dir(spark, "payloads"))
    decided = Places.put(revisits(long), "row", "revisits")
    # one sequential file per task, so the index in file order is the order of the archive
    return written(pages.mapInArrow(_writer(folder, decided, file_bytes, level), _INDEX), f"{folder}/index")


def _parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda s: int(x) if (x := s.removeprefix("<urn:page:").partition(":")[0]) else None
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None}


_RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def ranges(rows: Iterator[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Coalesce records sorted by (file, offset) to (file, start, end, members): holes up to ``gap`` bytes are read over."""
    file, start, end, members = None, 0, 0, []
    for f, offset, length in rows:
        if members and (f != file or offset - end > gap or offset + length - start > most):
            yield file, start, end, members
            members = []
        if not members:
            file, start, end = f, offset, offset
        members.append((offset, length))
        end = max(end, offset + length)
    if members:
        yield file, start, end, members


@shipped
def read_warc(spark: SparkSession, folder: str, selected: DataFrame | None = None, *, gap: int = 64 << 10, most: int = 8 << 20, task_bytes: int = 8 << 20, keep_payload: bool = True) -> DataFrame:
    """Records of ``selected`` index rows (all, if none are given), by sorted and coalesced byte-range reads.

    There is a task for each ``task_bytes`` of records, with neighbouring ones: an explicit number, as adaptive execution
    would see only the few bytes of the index.
    """
    index = selected if selected is not None else spark.read.schema(_INDEX).parquet(f"{folder}/index")
    index = index.select("file", "offset", "length")
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 1) // task_bytes)
    todo = index.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        name, source = None, None
        rows = (row for batch in it for row in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
        for file, start, end, members in ranges(rows, gap, most):
            if file != name:
                name, source = file, fs.open_input_file(f"{root}/{file}")
            source.seek(start)
            data, out, held = source.read(end - start), [], 0
            for offset, length in members:
                record = _parse(zlib.decompress(data[offset - start : offset - start + length], wbits=31))
                if not keep_payload:
                    record["payload"] = None
                out.append(record)
                held += len(record["payload"] or b"")
                if held > most or len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, _RECORDS_ARROW)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, _RECORDS_ARROW)

    return todo.mapInArrow(run, _RECORDS)


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages`` in a new folder of the shared store and read every record back."""
    folder = shared_dir(pages.sparkSession, "warc")
    write_warc(pages, folder, **options)
    return read_warc(pages.sparkSession, folder, keep_payload=False)
