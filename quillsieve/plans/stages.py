"""The curation pipeline as a list of DataFrame stages that can be skipped by name (section 3.1)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.policy import DEFAULT, Policy, licence
from quillsieve.operators import agreement, audit, dedup, release, scoring

Stage = Callable[["State"], "State"]


@dataclass(frozen=True)
class State:
    """What a stage gets and gives: immutable, lazily evaluated tables."""

    index: DataFrame
    boxes: DataFrame
    preds: DataFrame | None = None
    datasets: DataFrame | None = None
    policy: Policy = DEFAULT

    def with_index(self, index: DataFrame) -> State:
        return State(index, self.boxes, self.preds, self.datasets, self.policy)


def licences(s: State) -> State:
    """Licence verdict of each image's dataset."""
    if s.datasets is None:
        return s
    verdicts = s.datasets.select("dataset_id", licence(F.col("license_type"))["verdict"].alias("licence_verdict"))
    return s.with_index(s.index.join(verdicts, "dataset_id", "left"))


def audited(s: State) -> State:
    """Audit verdicts on rows that are not rejected; all others of them go (back) to review (TRAP-05)."""
    checked = audit.image_audit(s.index.where("status <> 'rejected'"), s.boxes, s.policy).select("image_id", "verdict", "reasons")
    out = s.index.join(checked, "image_id", "left")
    status = F.when(F.col("verdict").isNull(), F.col("status")).when(F.col("verdict") == "rejected", "rejected").otherwise("review")
    reason = (
        F.when(F.col("verdict") == "rejected", F.concat(F.lit("Failed annotation audit: "), "reasons")).when(F.col("verdict") == "review", F.concat(F.lit("Annotation audit flag: "), "reasons"))
        .when(F.col("verdict") == "pass", "Passed annotation audit - Awaiting image metrics").otherwise(F.col("reason"))
    )
    return s.with_index(out.withColumns({"status": status, "reason": reason}).drop("verdict", "reasons"))


def filtered(s: State) -> State:
    """Images below the least resolution are rejected (DOM-45)."""
    small = (F.col("status") != "rejected") & ((F.col("width") < s.policy.min_width) | (F.col("height") < s.policy.min_height))
    return s.with_index(s.index.withColumns({"status": F.when(small, "rejected").otherwise(F.col("status")), "reason": F.when(small, "Resolution below the minimum").otherwise(F.col("reason"))}))


def agreed(s: State) -> State:
    """Detector agreement, where predictions are given."""
    if s.preds is None:
        return s
    found = agreement.agreement_scores(agreement.greedy_match(s.boxes, s.preds, s.policy)).select("image_id", "f1", F.col("agreement").alias("yolo_agreement"), F.col("n_preds").alias("yolo_box_count"), "missing_ratio")
    return s.with_index(s.index.drop("f1", "yolo_agreement", "yolo_box_count", "missing_ratio").join(found, "image_id", "left"))


def scored(s: State) -> State:
    """Calibrated scores and routing; rows the policy skips keep their status."""
    routed = scoring.route_v2(scoring.score_v2(s.index, audit.annotation_flags(s.boxes, s.policy), s.policy), s.policy).select("image_id", "overall", "routed", "band")
    out = s.index.join(routed, "image_id", "left")
    return s.with_index(out.withColumn("status", F.coalesce("routed", "status")).drop("routed"))


def deduplicated(s: State) -> State:
    """Of equal files the best score stays; the others become duplicates."""
    live = s.index.where(~F.col("status").isin("rejected", "duplicate"))
    groups = dedup.exact_groups(live, "file_hash", "image_id", [-F.coalesce("overall", F.lit(0.0))])
    lost = groups.where("is_duplicate").select("image_id", F.lit("duplicate").alias("status"))
    return s.with_index(release.keyed_update(s.index, lost, "image_id"))


def exported(s: State) -> State:
    """Splits for accepted images."""
    splits = release.split_assignment(s.index.where("status = 'accepted'").select("image_id"), policy=s.policy)
    return s.with_index(s.index.join(splits, "image_id", "left"))


STAGES: dict[str, Stage] = {"licence": licences, "audit": audited, "filter": filtered, "agreement": agreed, "scoring": scored, "dedup": deduplicated, "export": exported}


def run(state: State, skip: tuple[str, ...] = ()) -> State:
    """All stages in order but those in ``skip``; unknown names are errors."""
    if unknown := set(skip) - set(STAGES):
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    for name, stage in STAGES.items():
        if name not in skip:
            state = stage(state)
    return state
