"""Review queue: rule flags, reasons, decomposition, triage (DOM-85..91, DOM-120, FLT-07, FLT-08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("Low score", "YOLO disagreement", "Blur", "Exposure", "Annotation overlap", "Border boxes", "Tiny boxes", "Clinical class review", "Duplicate")
PRIORITY = ("Clinical_Review", "Missing_Annotations", "High_Model_Disagreement", "Low_Model_Confidence", "Border_Issues", "Image_Quality")


def _yes(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def rule_flags(scored: DataFrame) -> DataFrame:
    """One boolean a rule for scored images with annotation flags (DOM-85); ``rule_<n>`` in the order of RULES."""
    apart = F.abs(F.coalesce("n_boxes", F.lit(0)) - F.coalesce("yolo_box_count", F.lit(0))) > 5
    found = (
        (F.col("overall") < 8.0) & (F.col("status") != "rejected"), (F.coalesce("yolo_agreement", F.lit(10.0)) < 8.0) | apart, F.col("norm_blur") < 4.0, F.col("norm_exposure") < 6.0,
        _yes("has_overlap"), _yes("has_border"), _yes("has_tiny"), _yes("has_clinical"), F.col("status") == "duplicate",
    )
    return scored.withColumns({f"rule_{k}": F.coalesce(c, F.lit(False)) for k, c in enumerate(found)})


def rule_contributions(flagged: DataFrame) -> DataFrame:
    """Images a rule fires on and their share, in one pass (AGG-12)."""
    one = flagged.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"rule_{k}")).alias(f"c{k}") for k in range(len(RULES))])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"c{k}").alias("images")) for k, r in enumerate(RULES)])
    out = one.select("n", F.explode(pairs).alias("x"))
    return out.select("x.rule", "x.images", F.round(F.when(F.col("n") > 0, F.col("x.images") * 100.0 / F.nullif("n", F.lit(0))).otherwise(0.0), 6).alias("pct"))


def single_or_multiple(flagged: DataFrame) -> DataFrame:
    """Images under review by their only rule, or as of multiple reasons; text decides where no rule fires (DOM-86)."""
    active = F.filter(F.array(*[F.when(F.col(f"rule_{k}"), F.lit(r)) for k, r in enumerate(RULES)]), lambda x: x.isNotNull())
    text = F.lower("reason")
    fallback = (
        F.when(text.contains("below auto-accept"), "Low score").when(text.contains("yolo agreement"), "YOLO disagreement")
        .when(text.contains("clinical class") | text.contains("contains class"), "Clinical class review").when(text.contains("overlap"), "Annotation overlap").otherwise("Low score")
    )
    kind = F.when(F.size(active) > 1, "Multiple reasons").when(F.size(active) == 1, F.get(active, 0)).otherwise(fallback)
    return flagged.where("status = 'review'").groupBy(kind.alias("review_reason")).agg(F.count("*").alias("images"))


def reasons(scored: DataFrame) -> DataFrame:
    """Primary and secondary reasons of images under review, by priority (DOM-87, WIN-07)."""
    apart = F.abs(F.coalesce("n_boxes", F.lit(0)) - F.coalesce("yolo_box_count", F.lit(0))) > 5
    confidence = F.coalesce("mean_confidence", F.lit(0.0))
    found = (
        _yes("has_clinical"), F.coalesce("missing_ratio", F.lit(0.0)) >= 0.40, (F.coalesce("f1", F.lit(0.0)) < 0.50) | apart,
        (confidence > 0) & (confidence < 0.40), _yes("has_border"), (F.col("norm_blur") < 4.0) | (F.col("norm_exposure") < 6.0),
    )
    active = F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in zip(found, PRIORITY)]), lambda x: x.isNotNull())
    out = scored.where("status = 'review'").select("image_id", active.alias("active"))
    n = F.size("active")
    return out.select(
        "image_id", F.coalesce(F.get("active", 0), F.lit("Image_Quality")).alias("primary_reason"),
        F.when(n > 1, F.array_join(F.slice("active", 2, 10), ",")).otherwise("None").alias("secondary_reasons"),
        F.when(n > 0, F.array_join("active", " + ")).otherwise("Unknown").alias("combination"), "active",
    )


def combinations(found: DataFrame) -> DataFrame:
    """Combinations of reasons by count and share of the queue (AGG-20)."""
    counts = found.groupBy("combination").agg(F.count("*").alias("images"))
    total = counts.agg(F.sum("images").alias("total"))
    return counts.join(F.broadcast(total)).select("combination", "images", F.round(F.col("images") * 100.0 / F.col("total"), 6).alias("pct"))


def categories(found: DataFrame) -> DataFrame:
    """(category, image_id): an image is listed under its primary and each secondary reason (DOM-88)."""
    listed = F.array_union(F.array("primary_reason"), "active")
    return found.select(F.explode(listed).alias("category"), "image_id")


def border_audit(boxes: DataFrame) -> DataFrame:
    """Boxes by the two border rules: strict 1 %, and inclusive 0.005 with size (TRAP-26, DOM-89)."""
    x, y, w, h = (F.col(c) for c in ("xc", "yc", "w", "h"))
    strict = (x - w / 2.0 < 0.01) | (x + w / 2.0 > 0.99) | (y - h / 2.0 < 0.01) | (y + h / 2.0 > 0.99)
    wide = ((x - w / 2.0 <= 0.005) | (x + w / 2.0 >= 0.995) | (y - h / 2.0 <= 0.005) | (y + h / 2.0 >= 0.995)) & ((w > 0.04) | (h > 0.04))
    kind = F.when(strict & wide, "problematic").when(strict, "acceptable").when(wide, "problematic_only").otherwise("inside")
    return boxes.groupBy(kind.alias("border")).agg(F.count("*").alias("boxes"), F.countDistinct("image_id").alias("images"))


def visual_bands(metrics: DataFrame) -> DataFrame:
    """Images in the visual inspection bands of blur, exposure (0..255) and F1 (DOM-91)."""
    blur, light, f1 = F.col("raw_blur"), F.col("exposure_pct") * 2.55, F.col("f1")
    return metrics.select(
        "image_id",
        F.when(blur >= 200, "high").when((blur >= 20) & (blur <= 40), "medium").when(blur < 10, "low").alias("blur_band"),
        F.when((light >= 110) & (light <= 140), "good").when(((light >= 70) & (light <= 90)) | ((light >= 180) & (light <= 210)), "fair").when((light < 40) | (light > 230), "poor").alias("exposure_band"),
        F.when(f1 >= 0.85, "high").when((f1 >= 0.50) & (f1 <= 0.65), "medium").when(f1 < 0.30, "low").alias("f1_band"),
    )


def reset_statuses(index: DataFrame) -> DataFrame:
    """Back to review, but for duplicates and audit rejections named by the literal pattern (DOM-90, TRAP-06)."""
    kept = (F.col("status") == "duplicate") | F.coalesce((F.col("status") == "rejected") & F.col("reason").like("Annotation audit%"), F.lit(False))
    return index.withColumn("status", F.when(kept, F.col("status")).otherwise("review"))


def queue(index: DataFrame, dataset_id: str | None = None) -> DataFrame:
    """Rows under review, scores shown as 0 where missing (DOM-120, TRAP-25)."""
    out = index.where("status = 'review'")
    return out if dataset_id is None else out.where(F.col("dataset_id") == dataset_id)


def resolve(index: DataFrame, decisions: DataFrame) -> DataFrame:
    """``index`` with statuses overridden by ``decisions`` (image_id, decision, why); a decision is one of three (DOM-120)."""
    checked = F.when(F.col("decision").isin("accepted", "rejected", "ignored"), F.col("decision")).otherwise(F.raise_error(F.lit("a decision is accepted, rejected or ignored")))
    known = decisions.select("image_id", checked.alias("decision"), F.coalesce("why", F.lit("Manually resolved")).alias("why"))
    out = index.join(known, "image_id", "left")
    return out.withColumns({"status": F.coalesce("decision", "status"), "reason": F.when(F.col("decision").isNotNull(), F.col("why")).otherwise(F.col("reason"))}).drop("decision", "why")
