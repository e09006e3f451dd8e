"""Cutting lineage: intermediate tables in the folder all executors share.

A long plan that is read more than once is written as Parquet below
``spark.checkpoint.dir`` and read back.  The copy survives lost executors, and
its file sizes give Catalyst real statistics, so that a join side is broadcast
only when it was measured to be small.  Tables written within a ``scratch``
block go at its end, but for those it keeps.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_OPEN: list[Scratch] = []


class Scratch:
    """The tables written in one ``scratch`` block."""

    def __init__(self) -> None:
        self.paths: dict[str, SparkSession] = {}
        self.kept: set[str] = set()

    def keep(self, *tables: DataFrame) -> None:
        """Tables that outlive the block: those its result still reads."""
        self.kept |= {t.written_path for t in tables}


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch() -> Iterator[Scratch]:
    """Deletes what ``written`` writes inside, once it ends; kept tables pass to the block around it.

    A table may only be deleted when nothing lazy reads it any more: every
    table made from it was itself written, or it is kept.
    """
    block = Scratch()
    _OPEN.append(block)
    try:
        yield block
    finally:
        _OPEN.pop()
        for path, spark in block.paths.items():
            if path not in block.kept:
                _delete(spark, path)
            elif _OPEN:
                _OPEN[-1].paths[path] = spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a temporary one on a local master only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="quillsieve-")
    return _LOCAL["dir"]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder; it goes with the ``scratch`` block it was named in."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].paths[path] = spark
    return path


def written(df: DataFrame, label: str, rows: int | None = None, per_task: int = 200_000) -> DataFrame:
    """Write ``df`` to the shared folder and read it back with its own schema.

    ``rows``, where the caller has an upper bound, sizes the last stage by the
    data: a small table is not written by as many tasks as a large shuffle has.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if rows is not None:
        df = df.coalesce(max(8, -(-rows // per_task)))
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back
