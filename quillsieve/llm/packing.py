"""Operator 5: bounded-space online packing of token ids into fixed sequences.

Every scan partition keeps at most ``open_windows`` unfinished windows.  A
document's ids are cut into whole windows and one remainder; the remainder goes
best-fit (least room that still holds it).  When none fits and no new window
may be opened, the fullest is topped up with the front of the remainder and
emitted; room of fewer than ``min_cut`` ids is padded rather than filled with a
sliver.  What the partitions leave open is merged in rounds of bounded groups,
so no task ever gets more than ``GROUP`` windows; the last round cuts freely.

Defined results: a null or empty text has only the closing id; a text of any
length is cut into as many windows as it takes, its ids held by one task; an
empty table gives no rows; repeated rows are packed once each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.words import release
from quillsieve.plans.cut import written

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_STAGED = PIECE + ", ids binary, slot long"
GROUP = 1024


class Packer:
    """Open windows of one task. Rows are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, open_windows: int, min_cut: int, first_id: int):
        self.capacity, self.open_windows, self.min_cut, self.next_id = capacity, open_windows, min_cut, first_id
        self.windows: list[list] = []  # [fill, [piece, ...]]
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset, None, None))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        cap = self.capacity
        while len(ids) >= cap:
            self._emit([(doc_id, start, ids[:cap], total)])
            start, ids = start + cap, ids[cap:]
        while len(ids):
            n = len(ids)
            fits = [w for w in self.windows if cap - w[0] >= n]
            if fits:
                best = max(fits, key=lambda w: w[0])
                best[0] += n
                best[1].append((doc_id, start, ids, total))
                if best[0] == cap:
                    self.windows.remove(best)
                    self._emit(best[1])
                return
            if len(self.windows) < self.open_windows:
                self.windows.append([n, [(doc_id, start, ids, total)]])
                return
            full = max(self.windows, key=lambda w: w[0])
            self.windows.remove(full)
            room = cap - full[0]
            if room >= self.min_cut:
                full[1].append((doc_id, start, ids[:room], total))
                start, ids = start + room, ids[room:]
            self._emit(full[1])

    def left(self) -> Iterator[tuple]:
        for slot, (_, pieces) in enumerate(self.windows):
            for doc_id, start, ids, total in pieces:
                yield (doc_id, start, len(ids), None, total, None, None, ids.tobytes(), slot)
        self.windows = []

    def finish(self) -> None:
        """Fills windows one after another; only the very last may be short."""
        pieces = sorted((p for w in self.windows for p in w[1]), key=lambda p: -len(p[2]))
        self.windows, held, fill = [], [], 0
        for doc_id, start, ids, total in pieces:
            while len(ids):
                part = ids[: self.capacity - fill]
                held.append((doc_id, start, part, total))
                start, ids, fill = start + len(part), ids[len(part) :], fill + len(part)
                if fill == self.capacity:
                    self._emit(held)
                    held, fill = [], 0
        if held:
            self._emit(held)


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("slot", pa.int64()),
])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def pack(docs: DataFrame, tokenizer: str | None = None, *, capacity: int = 2048, open_windows: int = 24, min_cut: int = 16, end_id: int = 1, block: int = 300) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of ``capacity`` ids, one row per piece.

    Tokenising and packing are one pass over the scan; only the open windows'
    ids are written for merging, ``open_windows`` per partition.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        from pyspark import TaskContext

        from quillsieve.llm.tokenize import close, default_path, opened

        release()  # what earlier tasks left in this worker
        encoder, end = opened(tokenizer or default_path()), np.array([end_id], np.int32)
        packer = Packer(capacity, open_windows, min_cut, TaskContext.get().partitionId() << 32)
        gc.disable()
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, block):
                    part = batch.slice(at, block)
                    texts = part.column(1).cast(pa.binary()).to_pylist()
                    for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                        ids = np.concatenate([ids, end])
                        packer.add(doc_id, 0, ids, len(ids))
                yield _batch(packer.out)
                packer.out = []
        finally:  # a stopped task, too, leaves its worker as it was
            gc.enable()
            close()
            release()
        packer.out += packer.left()
        yield _batch(packer.out)

    def merging(turn: int, last: bool):
        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer, group = None, None
            for batch in batches:
                for g, slot, doc_id, start, total, ids in zip(*(c.to_pylist() for c in batch.columns)):
                    if g != group:
                        if packer:
                            packer.finish() if last else packer.out.extend(packer.left())
                            yield _batch(packer.out)
                        group, packer = g, Packer(capacity, open_windows, min_cut, ((turn << 24 | g) << 32))
                    ids = np.frombuffer(ids, np.int32)
                    if last:
                        packer.windows.append([len(ids), [(doc_id, start, ids, total)]])
                    else:
                        packer.add(doc_id, start, ids, total)
            if packer:
                packer.finish() if last else packer.out.extend(packer.left())
                yield _batch(packer.out)

        return merge

    staged = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, _STAGED)
    staged = written(staged.withColumn("part", F.spark_partition_id()), "pack")
    done, turn = [staged.where("ids is null")], 1
    left = staged.where("ids is not null")
    while True:
        windows = left.select("part", "slot").distinct().count()
        groups = -(-windows // GROUP)
        if not groups:
            break
        keyed = left.select(
            F.pmod(F.col("part"), F.lit(groups)).cast("long").alias("g"), F.col("part").cast("long").alias("part"), "slot", "doc_id", "start", "doc_tokens", "ids"
        )
        dealt = keyed.repartition(groups, "g").sortWithinPartitions("g", "part", "slot", "doc_id", "start").select("g", "slot", "doc_id", "start", "doc_tokens", "ids")
        merged = dealt.mapInArrow(merging(turn, groups == 1), _STAGED)
        if groups == 1:
            done.append(merged)
            break
        merged = written(merged.withColumn("part", F.spark_partition_id()), "pack")
        done.append(merged.where("ids is null"))
        left, turn = merged.where("ids is not null"), turn + 1
    columns = [c.split()[0] for c in PIECE.split(", ")]
    out = done[0].select(columns)
    for d in done[1:]:
        out = out.unionByName(d.select(columns))
    return out
