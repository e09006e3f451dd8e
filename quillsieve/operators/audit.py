"""Box geometry audit and image verdicts (DOM-20..31, DOM-07..10, JN-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions.geometry import iou, struct_iou
from quillsieve.functions.policy import CLINICAL, DEFAULT, Policy, class_name, clinical_action

_BOX = ("xc", "yc", "w", "h")

#: Rules by verdict, in the order in which reasons are listed; texts are this engine's own.
REJECTS = ("centre_outside", "degenerate", "edge_outside", "tiny")
REVIEWS = ("aspect", "giant")
_REASON = {"giant": "giant cluster"}  # scoring v1 looks for "cluster" and "overlapping" in reasons


def flags(policy: Policy = DEFAULT) -> dict[str, Column]:
    """One boolean a rule for a box in columns xc, yc, w, h."""
    x, y, w, h = (F.col(c) for c in _BOX)
    giant = w * h > policy.giant_area
    return {
        "centre_outside": (x < 0) | (x > 1) | (y < 0) | (y > 1),
        "degenerate": (w <= 0) | (h <= 0),
        "edge_outside": (x - w / 2.0 < 0) | (x + w / 2.0 > 1) | (y - h / 2.0 < 0) | (y + h / 2.0 > 1),
        "aspect": (w > 0) & (h > 0) & ((w / F.nullif(h, F.lit(0.0)) > policy.max_aspect) | (h / F.nullif(w, F.lit(0.0)) > policy.max_aspect)),
        "giant": giant,
        "tiny": ~giant & (w * h < policy.tiny_area),
    }


def box_flags(boxes: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Boxes with their rule flags and a verdict of their own."""
    rules = {k: F.coalesce(v, F.lit(False)) for k, v in flags(policy).items()}
    out = boxes.withColumns(rules)
    any_of = lambda names: F.greatest(*[F.col(n) for n in names])
    return out.withColumn("box_verdict", F.when(any_of(REJECTS), "reject").when(any_of(REVIEWS), "review").otherwise("pass"))


def annotation_boxes(annotations: DataFrame) -> DataFrame:
    """Annotations with JSON payloads as boxes, and ``payload``: ok, corrupt, no_bbox or bad_length (DOM-21, DOM-22)."""
    bbox = F.from_json(F.get_json_object("data", "$.bbox"), "array<double>")
    payload = (
        F.when(F.get_json_object("data", "$").isNull(), "corrupt").when(F.get_json_object("data", "$.bbox").isNull(), "no_bbox")
        .when(F.coalesce(F.size(bbox), F.lit(-1)) != 4, "bad_length").otherwise("ok")
    )
    return annotations.withColumns({"payload": payload, **{c: F.when(payload == "ok", F.get(bbox, k)) for k, c in enumerate(_BOX)}})


def overlap_pairs(boxes: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Pairs of one image's boxes that overlap by more than the limit (JN-07, DOM-29)."""
    a = boxes.select("image_id", F.col("ann_seq").alias("a_seq"), *[F.col(c).alias(f"a_{c}") for c in _BOX])
    b = boxes.select("image_id", F.col("ann_seq").alias("b_seq"), *[F.col(c).alias(f"b_{c}") for c in _BOX])
    value = iou(*[F.col(f"a_{c}") for c in _BOX], *[F.col(f"b_{c}") for c in _BOX])
    return a.join(b, "image_id").where(F.col("a_seq") < F.col("b_seq")).withColumn("iou", value).where(F.col("iou") > policy.overlap_iou).select("image_id", "a_seq", "b_seq", "iou")


def _overlaps(boxes: Column, limit: float) -> Column:
    return F.exists(boxes, lambda a: F.exists(boxes, lambda b: (a["ann_seq"] < b["ann_seq"]) & (struct_iou(a, b) > limit)))


def image_audit(images: DataFrame, boxes: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Verdict and ordered reasons per image (DOM-30, DOM-31).

    One shuffle: an image's boxes come together once, and overlaps are found in
    its own array.  ``payload`` other than ok (if the column is there) rejects.
    """
    bad = F.coalesce(F.col("payload") != "ok", F.lit(False)) if "payload" in boxes.columns else F.lit(False)
    seen = box_flags(boxes, policy).withColumn("bad_payload", bad)
    order = ("bad_payload", "centre_outside", "degenerate", "edge_outside", "aspect", "giant", "tiny")
    reason = F.filter(F.array(*[F.when(F.col(n), F.concat(F.lit(_REASON.get(n, n) + " "), F.col("ann_seq").cast("string"))) for n in order]), lambda x: x.isNotNull())
    seen = seen.withColumn("reasons", reason).withColumn("rejecting", F.greatest("bad_payload", *REJECTS)).withColumn("reviewing", F.greatest(*REVIEWS))
    per = seen.groupBy("image_id").agg(
        F.max("rejecting").alias("rejecting"), F.max("reviewing").alias("reviewing"), F.count_if(~F.col("bad_payload")).alias("n_boxes"),
        F.array_sort(F.collect_list(F.struct("ann_seq", *_BOX, "reasons", "bad_payload"))).alias("boxes"),
    )
    usable = F.filter("boxes", lambda b: ~b["bad_payload"])
    pairs = F.flatten(F.transform(usable, lambda a: F.transform(F.filter(usable, lambda b: (a["ann_seq"] < b["ann_seq"]) & (struct_iou(a, b) > policy.overlap_iou)), lambda b: F.concat(F.lit("overlapping "), a["ann_seq"].cast("string"), F.lit("/"), b["ann_seq"].cast("string")))))
    joined = images.select("image_id", *[c for c in ("dataset_id",) if c in images.columns]).join(per, "image_id", "left")
    n = F.coalesce("n_boxes", F.lit(0)).cast("long")
    out = joined.withColumn("overlaps", F.coalesce(pairs, F.array())).withColumn("n_boxes", n)
    none = F.array().cast("array<string>")
    empty = F.when(F.col("n_boxes") == 0, F.array(F.lit("no boxes"))).otherwise(none)
    reasons = F.concat(F.coalesce(F.flatten(F.transform("boxes", lambda b: b["reasons"])), none), F.col("overlaps"), empty)
    review = F.coalesce("reviewing", F.lit(False)) | (F.size("overlaps") > 0) | (F.col("n_boxes") == 0)
    verdict = F.when(F.coalesce("rejecting", F.lit(False)), "rejected").when(review, "review").otherwise("pass")
    return out.select(*[c for c in joined.columns if c in ("image_id", "dataset_id")], "n_boxes", verdict.alias("verdict"), F.array_join(reasons, "; ").alias("reasons"))


def audit_summary(verdicts: DataFrame) -> DataFrame:
    """Images by verdict."""
    return verdicts.groupBy("verdict").agg(F.count("*").alias("images"))


def annotation_flags(boxes: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per image: counts and flags that scoring and review use (DOM-72..75, DOM-85)."""
    x, y, w, h = (F.col(c) for c in _BOX)
    near = lambda e: (x - w / 2.0 <= e) | (x + w / 2.0 >= 1 - e) | (y - h / 2.0 <= e) | (y + h / 2.0 >= 1 - e)
    inside = lambda e: (x - w / 2.0 < e) | (x + w / 2.0 > 1 - e) | (y - h / 2.0 < e) | (y + h / 2.0 > 1 - e)
    seen = boxes.select(
        "image_id", "ann_seq", *_BOX, (near(0.005) & ((w > 0.04) | (h > 0.04))).alias("problem_border"), inside(0.01).alias("border_1pct"),
        (w * h < policy.tiny_area).alias("tiny"), class_name(F.col("class_idx")).isin(*CLINICAL).alias("clinical"),
    )
    return seen.groupBy("image_id").agg(
        F.count("*").alias("n_boxes"), F.max("problem_border").alias("has_problem_border"), F.max("border_1pct").alias("has_border"), F.max("tiny").alias("has_tiny"),
        F.max("clinical").alias("has_clinical"), F.collect_list(F.struct("ann_seq", *_BOX)).alias("boxes"),
    ).withColumn("has_overlap", _overlaps(F.col("boxes"), policy.overlap_iou)).drop("boxes")


def clinical_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes with class name and clinical action (DOM-07)."""
    return boxes.withColumn("class_name", class_name(F.col("class_idx"))).withColumn("action", clinical_action(F.col("class_idx")))


def clinical_status(boxes: DataFrame) -> DataFrame:
    """rejected, review or unchanged by an image's classes (DOM-08)."""
    action = clinical_action(F.col("class_idx"))
    per = boxes.groupBy("image_id").agg(F.max(action == "REJECT").alias("r"), F.max(action == "REVIEW").alias("v"))
    return per.select("image_id", F.when(F.col("r"), "rejected").when(F.col("v"), "review").otherwise("unchanged").alias("clinical_status"))


def clinical_retention(boxes: DataFrame) -> DataFrame:
    """Boxes and share by action (DOM-09)."""
    counts = clinical_boxes(boxes).groupBy("action").agg(F.count("*").alias("boxes"))
    return counts.withColumn("pct", F.round(F.col("boxes") * 100.0 / F.sum("boxes").over(Window.partitionBy()), 6))


def provenance(boxes: DataFrame) -> DataFrame:
    """Per image: sorted distinct original, kept and removed classes (DOM-10, SET-03)."""
    seen = clinical_boxes(boxes)
    names = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("class_name")))), ",")
    kept = F.col("action").isin("KEEP", "REVIEW")
    return seen.groupBy("image_id").agg(names(F.lit(True)).alias("original_classes"), names(kept).alias("kept_classes"), names(~kept).alias("removed_classes"))
