"""Operator 8: removal of repeated multi-line passages.

Every two successive non-blank lines of a text, with the blank lines between
them, are a seed, found by a rolling hash over the two line hashes wherever
they stand.  A run of lines is repeated exactly if all its seeds are, so a
passage of two lines or more is removed from its first to its last line,
whatever surrounds it.  A seed that occurs more than once in the corpus stays
where it occurs first (smallest doc_id, then position) and its lines are
removed elsewhere, after its bytes were compared with those of the first.  The
first occurrence of a line always stays.

What is counted and joined are hashes and positions; texts of repeated seeds
alone travel for the comparison.

Defined results: null texts stay null; blank lines alone are never removed,
nor are those around a removed passage; repeats within one document count;
rows without doc_id keep their text and own nothing; rows that repeat an id and
its text are one document with one owner and lose or keep the same lines; texts
that share an id are told apart by their hash, ties for the first occurrence
going to the smaller one; a text of any length is cut whole, by one task; a
document whose whole text was repeated is left blank
(and ``deduplicated`` drops it); ``chunks_removed`` counts seeds; extra columns
are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.words import release, text_key
from quillsieve.plans.cut import scratch, written

WINDOW, MEAN_LINES, MOST_LINES = 2, 3, 64
MOST_BITS = 1 << 27  # of the bitmap that is broadcast, 16 MB
_M = (1 << 64) - 1


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """[start, end) of the content-defined chunks of a text's lines."""
    import xxhash

    out, start, before = [], 0, 0
    for i, line in enumerate(lines):
        h = xxhash.xxh3_64_intdigest(line)
        rolled = (before * 0x9E3779B97F4A7C15 + h) & _M
        before = h
        mixed = ((rolled ^ (rolled >> 31)) * 0xD6E8FEB86659FD93) & _M
        if (mixed >> 40) % MEAN_LINES == 0 and i - start + 1 >= WINDOW or i - start + 1 >= MOST_LINES:
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def seeds(lines: list[bytes]) -> list[tuple[int, int]]:
    """[start, end) from each non-blank line to the next one."""
    full = [i for i, line in enumerate(lines) if line.strip()]
    return [(i, j + 1) for i, j in zip(full, full[1:])]


def passages(text: bytes) -> list[tuple[int, bytes]]:
    """(position, bytes) of the seeds."""
    lines = text.split(b"\n")
    return [(a, b"\n".join(lines[a:b])) for a, b in seeds(lines)]


def without(text: bytes, positions: set[int]) -> bytes:
    """The text less the lines of the seeds at ``positions``."""
    lines = text.split(b"\n")
    gone = {i for a, b in seeds(lines) if a in positions for i in range(a, b)}
    return b"\n".join(x for i, x in enumerate(lines) if i not in gone)


def rolled(text: bytes) -> list[tuple[int, int]]:
    """(position, signed 64-bit hash) of the seeds; blank lines between the two count by their bytes."""
    import xxhash

    lines = text.split(b"\n")
    out, before, at = [], 0, None
    for i, line in enumerate(lines):
        if not line.strip():
            continue
        h = xxhash.xxh3_64_intdigest(line)
        if at is not None:
            gap = 0 if i == at + 1 else xxhash.xxh3_64_intdigest(b"\n".join(lines[at + 1 : i]), i - at)
            mixed = ((before * 0x9E3779B97F4A7C15 + h) ^ gap) & _M
            out.append((at, (((mixed ^ (mixed >> 31)) * 0xD6E8FEB86659FD93) & _M) - (1 << 63)))
        before, at = h, i
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        ids, keys, at, hashes = [], [], [], []
        for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            for k, h in rolled(text or b""):
                ids.append(doc_id)
                keys.append(key)
                at.append(k)
                hashes.append(h)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, keys, at, hashes)], names=["doc_id", "key", "at", "hash"])
    release()


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "key", "at", "hash", "first", "chunk"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        rows, size = [], 0
        for i in range(batch.num_rows):  # one text at a time, as some are very long
            doc_id, key, marks = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(3)[i].values
            lines = (batch.column(2)[i].as_buffer() or pa.py_buffer(b"")).to_pybytes().split(b"\n")
            for at, mark, first in zip(*(marks.field(f).to_numpy(zero_copy_only=False) for f in ("at", "hash", "first"))):
                end = int(at) + 1
                while not lines[end].strip():
                    end += 1
                rows.append((doc_id, key, at, mark, first, b"\n".join(lines[at : end + 1])))
                size += len(rows[-1][-1])
                if size >= 1 << 22 or len(rows) >= 10_000:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)
    release()


def _listed(lists: DataFrame):
    """A test of (doc_id, key): true for every text in ``lists`` and for few others, so that only such texts are shuffled for a join.

    A bitmap of 16 bits a listed text, at most ``MOST_BITS``; beyond that more
    texts pass it than need to, and the join behind it is exact anyway.
    """
    bits = min(MOST_BITS, max(1 << 15, 1 << (16 * lists.count()).bit_length()))
    place = lambda doc_id, key: F.pmod(F.xxhash64(doc_id, key), F.lit(bits))
    spots = lists.select(place(F.col("doc_id"), F.col("key")).alias("spot"))
    parts = spots.groupBy(F.expr("spot div 32768").alias("part")).agg(F.bitmap_construct_agg(F.col("spot") % 32768).alias("bitmap"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for part, some in parts.collect():  # bits / 32768 rows of 4096 bytes at most
        bitmap[part * 4096 : part * 4096 + 4096] = np.frombuffer(some, np.uint8)
    held = lists.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def among(spot: pa.Array) -> pa.Array:
        at = spot.to_numpy(zero_copy_only=False)
        return pa.array((held.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return lambda doc_id, key: among(place(doc_id, key))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, key, gone): the positions of the seeds to remove from the text with that id and hash, their bytes equal to those of their first occurrence."""
    with scratch() as block:
        texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
        found = written(texts.mapInArrow(_hashed, "doc_id long, key long, at long, hash long").distinct(), "chunks")
        first_doc = found.groupBy("hash").agg(F.min("doc_id").alias("owner"), F.count("*").alias("n")).where("n > 1").select("hash", "owner")
        first_doc = written(first_doc, "owners")
        held = written(found.join(first_doc, "hash"), "held")
        first = written(held.where("doc_id = owner").groupBy("hash").agg(F.min(F.struct("key", "at")).alias("first")), "firsts")
        is_first = (F.col("doc_id") == F.col("owner")) & (F.col("key") == F.col("first.key")) & (F.col("at") == F.col("first.at"))
        marks = held.join(first, "hash").select("doc_id", "key", "at", "hash", is_first.alias("first"))
        marks = written(marks.groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "hash", "first")).alias("marks")), "marks")
        bytes_ = texts.where(_listed(marks)(F.col("doc_id"), F.col("key"))).join(marks.hint("merge"), ["doc_id", "key"]).select("doc_id", "key", "text", "marks")
        bytes_ = written(bytes_.mapInArrow(_picked, "doc_id long, key long, at long, hash long, first boolean, chunk binary"), "chunk-bytes")
        owners = written(bytes_.where("first").select("hash", F.col("chunk").alias("owned")).dropDuplicates(["hash"]), "chunk-owners")
        rest = bytes_.where("not first").join(owners, "hash").where("chunk = owned").select("doc_id", "key", "at")
        gone = written(rest.groupBy("doc_id", "key").agg(F.collect_set("at").alias("gone")), "gone")
        block.keep(gone)
    return gone


def line_deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages removed from ``text`` and ``chunks_removed`` added."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        pairs = zip(texts.cast(pa.binary()).to_pylist(), gone.to_pylist())
        out = [None if t is None or g is None else without(t, set(g)).decode() for t, g in pairs]
        release()
        return pa.array(out, pa.string())

    gone = repeated_chunks(docs)
    doc_id, key = F.col("doc_id").cast("long"), text_key(F.col("text"))
    listed = _listed(gone)(doc_id, key)
    gone = gone.select(F.col("doc_id").alias("gone_id__"), F.col("key").alias("gone_key__"), F.col("gone").alias("gone__"))
    joined = docs.where(listed).join(gone.hint("merge"), (doc_id == F.col("gone_id__")) & (key == F.col("gone_key__")), "left")
    joined = joined.withColumn("cut__", cut(F.when(F.col("gone__").isNotNull(), F.col("text").cast("string")), F.col("gone__")))
    changed = F.when(F.col("gone__").isNotNull(), F.col("cut__")).otherwise(F.col("text").cast("string"))

    def columns(text, removed):
        return [*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "chunks_removed"), removed.cast("long").alias("chunks_removed")]

    rest = docs.where(~listed).select(*columns(F.col("text").cast("string"), F.lit(0)))
    return joined.select(*columns(changed, F.coalesce(F.size("gone__"), F.lit(0)))).union(rest)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns, repeated passages removed; documents of which nothing is left go."""
    out = line_deduplicated(docs).where(r"chunks_removed = 0 or text rlike '\\S'")
    columns = [F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes]
    return out.select(*columns)
