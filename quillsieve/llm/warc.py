"""Operator 10: WARC archives, written per task and read by splittable byte ranges.

Every record is a gzip member of its own.  A reader task owns the records that
start inside its byte range: it looks for gzip magic from the start of the
range, and takes a candidate only if the bytes there inflate and begin with a
WARC version line and headers that parse; from then on members follow one
another, the last one running past the end of the range.  A candidate inside
compressed data does not pass both tests, and a whole member is decoded and
its length checked before the next is read.

Records of equal payloads of at least ``REVISIT_BYTES`` bytes are stored once:
the smallest page_id holds the response, the others are revisits that name it.

Defined results: null html is an empty payload; rows without ``page_id`` are
always responses (id null); rows that repeat a page_id are responses unless a
smaller id has their payload; other columns are ignored; an empty table gives
no archive and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.plans.cut import fresh_path, written

REVISIT_BYTES = 100
MAGIC = b"\x1f\x8b\x08"
SPLIT = 16 << 20
READ = 1 << 20
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit's block has the HTTP headers only."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _store(path: str):
    """The file system of ``path`` and its path there; any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _writer(folder: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, total = None, 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    store, inner = _store(path)
                    store.create_dir(inner.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(inner, compression=None)
                member = _member(_record(page_id, url, html or b"", digest, refers_to), level)
                out.write(member)
                total += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([total], pa.int64())], names=["path", "size"])

    return write


def write_warc(pages: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) below ``folder``; (path, size) of the files that count.

    Each task attempt writes a file of its own; only those of successful
    attempts are in the result, so a lost executor leaves no half file in it.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    large = rows.where((F.length("html") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    first = written(first, "payloads")
    refers = F.when((F.length("html") >= REVISIT_BYTES) & (F.col("page_id") > F.col("first")), F.col("first"))
    out = rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return written(out.mapInArrow(_writer(folder, level), "path string, size long"), "warc-files")


class _Window:
    """Bytes of a file around a moving position."""

    def __init__(self, file, size: int, read: int = READ):
        self.file, self.size, self.read, self.base, self.data = file, size, read, 0, b""

    def at(self, position: int, n: int) -> bytes:
        if not self.base <= position or position + n > self.base + len(self.data):
            self.file.seek(position)
            self.base, self.data = position, self.file.read(max(n, self.read))
        return self.data[position - self.base : position - self.base + n]

    def find(self, position: int, end: int) -> int:
        """The next gzip magic that starts in [position, end), or -1."""
        while position < end:
            got = self.at(position, min(self.read, self.size - position))
            hit = got.find(MAGIC)
            if hit >= 0:
                return position + hit if position + hit < end else -1
            if position + len(got) >= self.size:
                return -1
            position += max(1, len(got) - len(MAGIC) + 1)
        return -1

    def inflate(self, position: int, most: int | None = None) -> tuple[bytes, int]:
        """The member at ``position`` (its first ``most`` bytes only, if given) and where it ends; raises zlib.error."""
        unpacker, parts, got = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            raw = self.at(position, min(65536, self.size - position))
            if not raw:
                raise zlib.error("truncated member")
            parts.append(unpacker.decompress(raw))
            got += len(parts[-1])
            position += len(raw) - len(unpacker.unused_data)
            if most is not None and got >= most:
                break
        return b"".join(parts), position


def _headers(record: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name and where the block begins; None if this is no WARC record."""
    end = record.find(b"\r\n\r\n")
    if not record.startswith(b"WARC/") or end < 0:
        return None
    fields = {}
    for line in record[:end].split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def _is_record(window: _Window, position: int) -> bool:
    try:
        head, _ = window.inflate(position, 4096)
    except zlib.error:
        return False
    return _headers(head) is not None or (head.startswith(b"WARC/") and b"\r\n\r\n" not in head)


def records(file, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records that start in [start, end) of a seekable file."""
    window, position = _Window(file, size), start
    if start:  # an archive begins with a record; any other range has to find its first
        while (position := window.find(position, end)) >= 0 and not _is_record(window, position):
            position += 1
    while 0 <= position < min(end, size):
        record, after = window.inflate(position)
        parsed = _headers(record)
        if parsed is None or len(record) < parsed[1] + int(parsed[0]["content-length"]):
            raise ValueError(f"bad WARC record at byte {position}")
        yield parsed[0], record[parsed[1] : parsed[1] + int(parsed[0]["content-length"])]
        position = after


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _reader(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = _store(path)
                rows, held = [], 0
                with store.open_input_file(inner) as file:
                    for fields, block in records(file, size, start, end):
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response":
                            if len(body) != length or hashlib.sha256(body).hexdigest() != digest:
                                raise ValueError(f"payload of {fields['warc-record-id']} does not match its headers")
                        rows.append((_page(fields["warc-record-id"]), length, digest, kind, _page(fields.get("warc-refers-to")), fields.get("warc-target-uri"), body if payloads and kind == "response" else None))
                        held += len(body) if payloads else 100
                        if held > 8_000_000:
                            yield _rows(rows)
                            rows, held = [], 0
                yield _rows(rows)

    return read


_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def read_warc(files: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """Records of the archives in ``files`` (path, size), by byte ranges of ``split`` bytes, dealt over tasks."""
    size = F.col("size").cast("long")
    ranges = files.where(size > 0).select("path", size.alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), size - 1, F.lit(split).cast("long"))).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split, F.col("size")))
    # ranges are few and small; a range a task
    tasks = max(1, int(files.agg(F.coalesce(F.sum(F.ceil(size / split)), F.lit(1))).first()[0]))
    return ranges.repartition(tasks, "path", "start").mapInArrow(_reader(payloads), RECORD)


def round_trip(pages: DataFrame, split: int = SPLIT) -> DataFrame:
    """Writes ``pages`` to a fresh folder of the shared store and reads the archives back."""
    files = write_warc(pages, fresh_path(pages.sparkSession, "warc"))
    return read_warc(files, split, payloads=False).drop("url", "payload")
