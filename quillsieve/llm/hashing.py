"""Operator 2: exact top-k of binary codes by incremental multi-index hashing.

A code of 64 sign bits is cut into four 16-bit segments.  Rows lie in blocks of
bounded size; a block holds, for each segment, its rows in buckets of the
segment's value.  A query meets every block, a block of queries at a time.  In
a block its search radius r grows from 0: the buckets whose values differ from
the query's segment in exactly r bits are read and their rows verified on whole
codes.  All rows within 4r + 3 bits are then known, since a row further than r
in each of the four segments is at least 4(r + 1) bits away; the search ends
once the k-th verified distance is no more than that (or every row is known).
The k best of every block are merged per query.

Ties are broken by the smaller id; a row is not its own neighbour.  Defined
results: rows without embedding or id have no code and neither ask nor answer;
missing, null and NaN numbers have bit 0; of fewer than k other rows all are
returned; rows that repeat an id are separate answers; a block is at most
``BLOCK`` rows, so memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.plans.cut import written

SEGMENTS, WIDTH = 4, 16
BLOCK, QUERIES = 32_768, 512
_MASKS = [np.array([sum(1 << b for b in c) for c in combinations(range(WIDTH), r)], np.uint32) for r in range(WIDTH + 1)]


def coded(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, code): bit i of the code is whether number i is above 0."""
    bit = lambda x, i: F.when(F.coalesce(x > 0, F.lit(False)) & ~F.coalesce(F.isnan(x), F.lit(False)), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    numbers = F.transform(F.slice(F.col(vector).cast("array<double>"), 1, 64), bit)
    code = F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return table.where(F.col(vector).isNotNull() & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), code.alias("code"))


class Block:
    """The rows of one block, bucketed by each segment."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.codes = ids[order], codes[order].view(np.uint64)
        self.rows, self.start = [], []
        for s in range(SEGMENTS):
            value = ((self.codes >> np.uint64(WIDTH * s)) & np.uint64(0xFFFF)).astype(np.int64)
            self.rows.append(np.argsort(value, kind="stable"))
            self.start.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << WIDTH))]))

    def top(self, query_id: int, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest rows with other ids."""
        seen = self.ids == query_id
        left = len(seen) - int(seen.sum())
        k = min(k, left)
        rows, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for r in range(WIDTH + 1):
            if len(rows) >= k and (not k or far[k - 1] <= SEGMENTS * r - 1):
                break
            found = []
            for s in range(SEGMENTS):
                value = (int(code) >> (WIDTH * s)) & 0xFFFF
                near = (value ^ _MASKS[r]).astype(np.int64)
                lo, n = self.start[s][near], self.start[s][near + 1] - self.start[s][near]
                some = n > 0
                lo, n = lo[some], n[some]
                if len(n):
                    found.append(self.rows[s][np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
            if not found:
                continue
            new = np.concatenate(found)
            new = np.unique(new[~seen[new]])
            if not len(new):
                continue
            seen[new] = True
            rows = np.concatenate([rows, new])
            far = np.concatenate([far, np.bitwise_count(self.codes[new] ^ code).astype(np.int64)])
            best = np.lexsort((self.ids[rows], far))[:k]
            rows, far = rows[best], far[best]
        return self.ids[rows], far


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, neighbor_id, distance) for ``queries`` against ``codes``, both (id, code)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(block: int) -> pa.RecordBatch:
            ids, code = (np.concatenate(x) for x in zip(*held.pop(block)))
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([code.tobytes()], pa.binary())], names=["block", "ids", "codes"])

        for batch in batches:
            block, ids, code = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            cuts = np.flatnonzero(np.diff(block)) + 1
            for b, i, c in zip(np.split(block, cuts), np.split(ids, cuts), np.split(code, cuts)):
                if len(b):
                    for other in [x for x in held if x != b[0]]:
                        yield out(other)
                    held.setdefault(int(b[0]), []).append((i, c))
        for b in list(held):
            yield out(b)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = None, None
        for batch in batches:
            for b, ids, code, asked, asked_codes in zip(*(c.to_pylist() for c in batch.columns)):
                if b != name:
                    name, block = b, Block(np.frombuffer(ids, np.int64), np.frombuffer(code, np.int64))
                rows = [(q, *block.top(int(q), c, k)) for q, c in zip(np.frombuffer(asked, np.int64), np.frombuffer(asked_codes, np.uint64))]
                query = np.concatenate([np.full(len(n), q) for q, n, _ in rows])
                near, far = (np.concatenate([r[x] for r in rows]) for x in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (query, near, far)], names=["query_id", "neighbor_id", "distance"])

    def blocked(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
        blocks = -(-rows.count() // size)
        block = F.pmod(F.xxhash64("id", "code"), F.lit(max(1, blocks))).alias("block")
        dealt = rows.select(block, "id", "code").repartition(max(1, blocks), "block").sortWithinPartitions("block")
        return written(dealt.mapInArrow(pack, "block long, ids binary, codes binary"), "blocks"), blocks

    data, n = blocked(codes, BLOCK)
    asked, _ = blocked(queries, QUERIES)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n - 1)).cast("long"))).alias("block")
    asked = asked.select(every, F.col("ids").alias("asked"), F.col("codes").alias("asked_codes"))
    met = data.join(asked, "block").select("block", "ids", "codes", "asked", "asked_codes")
    best = met.mapInArrow(search, "query_id long, neighbor_id long, distance long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return best.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
