"""Command line: python -m quillsieve COMMAND --tables FOLDER --output FOLDER [options].

``--tables`` holds index.parquet and boxes.parquet (preds.parquet and datasets.parquet where there are any), as
``sources.fixtures`` describes them.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.policy import DEFAULT
from quillsieve.operators import agreement, audit, dedup, release, review, scoring, stats
from quillsieve.plans import stages


def _state(spark: SparkSession, folder: str, dataset_id: str | None) -> stages.State:
    def table(name: str, needed: bool = True) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{folder}/{name}.parquet")
        except Exception as e:
            if needed or "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    index = table("index")
    if dataset_id:
        index = index.where(F.col("dataset_id") == dataset_id)
    return stages.State(index, table("boxes"), table("preds", False), table("datasets", False), DEFAULT)


def _scored(s: stages.State) -> DataFrame:
    return scoring.score_v1(s.index, audit.annotation_flags(s.boxes))


COMMANDS = {
    "audit": lambda s, a: audit.image_audit(s.index.where("status <> 'rejected'"), s.boxes),
    "agreement": lambda s, a: agreement.agreement_scores(agreement.greedy_match(s.boxes, s.preds)),
    "score": lambda s, a: scoring.route_v2(scoring.score_v2(s.index, audit.annotation_flags(s.boxes))),
    "score-v1": lambda s, a: scoring.route_v1(_scored(s)),
    "dedup": lambda s, a: dedup.exact_groups(s.index, "file_hash", "image_id", [-F.coalesce("raw_blur", F.lit(0.0))]),
    "near": lambda s, a: dedup.near_pairs(s.index.withColumn("bits", dedup.hash_bits(F.col("perceptual_hash")))),
    "review": lambda s, a: review.queue(s.index),
    "reasons": lambda s, a: review.reasons(_scored(s)),
    "export": lambda s, a: release.split_assignment(s.index.where("status = 'accepted'"), seed=str(a.seed)),
    "dashboard": lambda s, a: stats.dashboard(s.index, s.boxes),
    "pipeline": lambda s, a: stages.run(s, tuple(a.skip)).index,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillsieve", description=__doc__)
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("--tables", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--dataset_id")
    parser.add_argument("--skip", nargs="*", default=[])
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("quillsieve").getOrCreate()
    COMMANDS[args.command](_state(spark, args.tables, args.dataset_id), args).write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
