"""Composite scores, status routing and quality bands (DOM-45..47, DOM-60..83)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.policy import DEFAULT, Policy, missing


def _clamp(x: Column, lo: float = 1.0, hi: float = 10.0) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


def diversity(images: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Resolution gate, lighting and skin-tone proxy from lightness in 0..1 (DOM-45..47)."""
    light = F.col("exposure_pct") / 100.0
    return images.select(
        "image_id", "dataset_id", ((F.col("width") < policy.min_width) | (F.col("height") < policy.min_height)).alias("too_small"),
        F.when(light < 0.25, "low_light").when(light > 0.75, "high_exposure").otherwise("optimal").alias("lighting"),
        F.when(light > 0.70, "L1").when(light > 0.45, "L2").otherwise("L3").alias("skin_tone"),
    )


def _mix(img: Column, ann: Column, agree: Column, policy: Policy) -> Column:
    a, b, c = policy.weights
    return _clamp(img * a + ann * b + agree * c)


def score_v1(index: DataFrame, flags: DataFrame, policy: Policy = DEFAULT, legacy_exposure: bool = True) -> DataFrame:
    """The first scoring policy with its scale quirks kept (TRAP-02..05); stages are pure, raw values stay (TRAP-04).

    ``duplicate_risk`` and ``cluster_quality`` are the constant 10 (DOM-68).
    """
    blur = _clamp(missing(F.col("raw_blur"), 50.0) / 20.0)
    exposure = missing(F.col("exposure_pct"), 127.0)
    pct = F.when(exposure > 10, exposure / 2.55).otherwise(exposure) if legacy_exposure else exposure
    norm_exp = F.greatest(F.lit(1.0), 10.0 - F.abs(pct - 50.0) / 5.0)
    res = F.when((F.col("width") >= 640) & (F.col("height") >= 640), 10.0).otherwise(5.0)
    agree = F.coalesce("yolo_agreement", F.lit(10.0))
    n = F.coalesce("n_boxes", F.lit(0))
    invalid = F.lit(0)  # no audit ever marks a box invalid (TRAP-09)
    ann = 10.0 - F.when(n > 0, invalid * 5.0 / F.nullif(n, F.lit(0))).otherwise(3.0) - F.when(n > 40, 2.0).otherwise(0.0)
    ann = ann - F.when(F.col("reason").contains("overlapping"), 2.0).otherwise(0.0) - F.when(F.col("reason").contains("cluster"), 1.5).otherwise(0.0)
    out = index.where(F.col("status") != "rejected").join(flags, "image_id", "left")
    out = out.withColumns({"norm_blur": blur, "norm_exposure": norm_exp, "annotation_quality": _clamp(ann), "agreement": agree, "n_boxes": n.cast("long")})
    out = out.withColumn("image_quality", F.round(F.col("norm_blur") * 0.4 + F.col("norm_exposure") * 0.4 + res * 0.2, 2))
    out = out.withColumn("overall", F.round(_mix(F.col("image_quality"), F.col("annotation_quality"), F.col("agreement"), policy), 2))
    severity = F.when(F.col("n_boxes") < 5, "mild").when(F.col("n_boxes") <= 20, "moderate").otherwise("severe")
    return out.withColumns({"severity": severity, "duplicate_risk": F.lit(10.0), "cluster_quality": F.lit(10.0)})


def route_v1(scored: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Status after scoring v1 (DOM-67); duplicates keep their status unless rejected."""
    warned = F.lower("reason").rlike("flag|discrepancy|blurry|failed|leakage")
    status = (
        F.when(F.col("overall") < policy.reject_score, "rejected").when(F.col("status") == "duplicate", "duplicate").when(warned, "review")
        .when(F.col("overall") >= policy.accept_score, "accepted").otherwise("review")
    )
    return scored.withColumn("routed", status)


def score_v2(index: DataFrame, flags: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The calibrated policy (DOM-70..78); exposure is the gray mean in 0..255."""
    skipped = (F.col("status") == "duplicate") | ((F.col("status") == "rejected") & F.lower("reason").contains("corruption"))  # never matches "Corrupted" (TRAP-06)
    blur = _clamp(F.coalesce("raw_blur", F.lit(50.0)) / 10.0)
    gray = F.coalesce(F.col("exposure_pct") * 2.55, F.lit(127.0))
    norm_exp = F.greatest(F.lit(1.0), 10.0 - F.abs(gray / 2.55 - 50.0) / 5.0)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    ann = 10.0 - F.when(yes("has_overlap"), 2.0).otherwise(0.0) - F.when(yes("has_tiny"), 1.0).otherwise(0.0) - F.when(yes("has_problem_border"), 2.0).otherwise(0.0)
    out = index.where(~skipped).join(flags, "image_id", "left")
    out = out.withColumns({"norm_blur": blur, "norm_exposure": norm_exp, "annotation_quality": ann, "agreement": F.coalesce("f1", F.lit(0.0)) * 10.0, "clinical": yes("has_clinical")})
    out = out.withColumn("image_quality", F.round(F.col("norm_blur") * 0.4 + F.col("norm_exposure") * 0.4 + 2.0, 2))
    return out.withColumn("overall", F.round(_mix(F.col("image_quality"), F.col("annotation_quality"), F.col("agreement"), policy), 2))


def route_v2(scored: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Status, band and joined reasons after scoring v2 (DOM-79)."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    warnings = {
        "overlapping boxes": yes("has_overlap"), "problematic border": yes("has_problem_border"), "tiny boxes": yes("has_tiny"), "clinical class": F.col("clinical"),
        "low agreement": F.col("agreement") < 5.0, "blurry": F.col("norm_blur") < 4.0, "exposure": F.col("norm_exposure") < 6.0,
    }
    listed = F.array_join(F.array(*[F.when(v, F.lit(k)) for k, v in warnings.items()]), "; ")
    out = scored.withColumn("warnings", listed)
    status = F.when(F.col("overall") < 5.0, "rejected").when(F.col("warnings") != "", "review").when(F.col("overall") >= policy.accept_score, "accepted").otherwise("review")
    out = out.withColumn("routed", status)
    return out.withColumn("band", F.when(F.col("routed") == "accepted", F.when(F.col("overall") >= 9.0, "Gold").otherwise("Silver")))


def band_5(score: Column, status: Column) -> Column:
    """Gold, Silver, Bronze, Review, Reject (DOM-80)."""
    hold = lambda band: F.when(status == "review", "Review").otherwise(band)
    return (
        F.when(status.isin("rejected", "duplicate"), "Reject").when(score >= 9.0, hold("Gold")).when(score >= 8.0, hold("Silver")).when(score >= 7.0, hold("Bronze"))
        .when((score >= 5.0) | (status == "review"), "Review").otherwise("Reject")
    )


def band_4(score: Column, status: Column) -> Column:
    """Gold, Silver, Review, Reject (DOM-81)."""
    return (
        F.when(status.isin("rejected", "duplicate"), "Reject").when(status == "review", "Review").when(score >= 9.0, "Gold").when(score >= 8.0, "Silver")
        .when(score >= 5.0, "Review").otherwise("Reject")
    )


def band_pools(score: Column, status: Column) -> Column:
    """The sampling pools: as band_4, but all below 8 that is not under review is Reject (DOM-83)."""
    return F.when(status.isin("rejected", "duplicate"), "Reject").when(status == "review", "Review").when(score >= 9.0, "Gold").when(score >= 8.0, "Silver").otherwise("Reject")


def band_simulated(score: Column, warned: Column) -> Column:
    """Bands a calibration would give (DOM-82)."""
    return F.when(score < 5.0, "Reject").when(warned, "Review").when(score >= 9.0, "Gold").when(score >= 8.0, "Silver").otherwise("Review")


def band_delta(current: DataFrame, simulated: DataFrame) -> DataFrame:
    """Images by band before and after (AGG-27); both (band)."""
    a, b = current.groupBy("band").agg(F.count("*").alias("now")), simulated.groupBy("band").agg(F.count("*").alias("then"))
    out = a.join(b, "band", "full").select("band", F.coalesce("now", F.lit(0)).alias("current_images"), F.coalesce("then", F.lit(0)).alias("simulated_images"))
    return out.withColumn("delta", F.col("simulated_images") - F.col("current_images"))
