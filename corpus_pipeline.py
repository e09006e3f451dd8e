"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

quality classifier -> line dedup -> MinHash near-dedup -> mixing -> packing.
All stages but the last return the columns of ``documents``; each works on all
that its predecessor kept.  The scorer, the sketches and the packing have no
SQL form, so ``ORACLE_SQL`` is None and tests compare with plain Python.

Defined results: null, empty and blank texts go in the first stage; rows
without an id pass all stages; rows that repeat an id and its text are one
document from the near-duplicate stage on, rows that share an id only are
documents of their own; null sources and languages are categories; extra
columns are carried to the last stage, whatever their names; texts of any
length are whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillsieve.llm import linededup, minhash, mixing, packing, quality
from quillsieve.plans.cut import scratch, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality.kept(docs, quality.fit(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that occur earlier in the corpus."""
    return linededup.deduplicated(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return minhash.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target marginals."""
    return mixing.sampled_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole ``documents`` table; what a stage wrote for itself goes when it ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch() as kept:
        for name, stage in STAGES:
            with scratch() as inner:
                docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
                inner.keep(docs)
        kept.keep(docs)
    return docs
