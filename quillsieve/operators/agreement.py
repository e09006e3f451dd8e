"""Label-versus-detector matching (JN-11, DOM-51..58)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.geometry import iou
from quillsieve.functions.policy import DEFAULT, Policy

_BOX = ("xc", "yc", "w", "h")


def greedy_match(truth: DataFrame, preds: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per image: counts of boxes, predictions and matches, and the IoUs of the matches.

    Labels are taken in order; each takes the best prediction that is still
    free (the earlier one wins ties), and keeps it if the IoU reaches the
    limit.  The order makes this a fold, done natively over an image's sorted
    candidate lists; images without a candidate are joined back with no match.
    """
    a = truth.select("image_id", F.col("ann_seq").alias("g"), *[F.col(c).alias(f"g_{c}") for c in _BOX])
    b = preds.select("image_id", F.col("pred_seq").alias("p"), *[F.col(c).alias(f"p_{c}") for c in _BOX])
    value = iou(*[F.col(f"g_{c}") for c in _BOX], *[F.col(f"p_{c}") for c in _BOX])
    near = a.join(b, "image_id").withColumn("iou", value).where(F.col("iou") > 0)
    lists = near.groupBy("image_id", "g").agg(F.array_sort(F.collect_list(F.struct((-F.col("iou")).alias("away"), F.col("p")))).alias("near"))
    lists = lists.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("g", "near"))).alias("labels"))
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<double>").alias("ious"))

    def take(state, label):
        free = F.filter(label["near"], lambda c: ~F.array_contains(state["used"], c["p"]))
        best = F.get(free, 0)
        ok = F.coalesce(-best["away"] >= policy.match_iou, F.lit(False))
        return F.struct(
            F.when(ok, F.concat(state["used"], F.array(best["p"]))).otherwise(state["used"]).alias("used"),
            F.when(ok, F.concat(state["ious"], F.array(-best["away"]))).otherwise(state["ious"]).alias("ious"),
        )

    matched = lists.select("image_id", F.aggregate("labels", start, take)["ious"].alias("ious"))
    n_truth = truth.groupBy("image_id").agg(F.count("*").alias("n_truth"))
    n_preds = preds.groupBy("image_id").agg(F.count("*").alias("n_preds"))
    out = n_truth.join(n_preds, "image_id", "full").join(matched, "image_id", "left")
    ious = F.coalesce("ious", F.array().cast("array<double>"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("image_id", zero("n_truth"), zero("n_preds"), F.size(ious).cast("long").alias("matches"), ious.alias("ious"))


def agreement_scores(matched: DataFrame) -> DataFrame:
    """Precision, recall, F1, ratios and the agreement score (DOM-52..56).

    The ratios' names are inverted against the stored counts, which is
    kept: missing_ratio is of predictions, missing_lesions of labels.
    """
    share = lambda a, b: F.when(b > 0, a / F.nullif(b, F.lit(0))).otherwise(0.0)
    m, t, p = F.col("matches"), F.col("n_truth"), F.col("n_preds")
    mean = F.when(m > 0, F.aggregate("ious", F.lit(0.0), lambda a, x: a + x) / F.nullif(m, F.lit(0))).otherwise(0.0)
    out = matched.withColumns({"precision": share(m, p), "recall": share(m, t), "mean_iou": mean, "missing_lesions": t - m, "extra_annotations": p - m})
    both = F.col("precision") + F.col("recall")
    penalty = F.when(m > 0, (1.0 - F.col("mean_iou")) * 4.0).otherwise(4.0)
    score = F.least(F.lit(10.0), F.greatest(F.lit(1.0), 10.0 - (t - m + p - m) * 1.2 - penalty))
    return out.withColumns({
        "f1": F.when(both > 0, F.col("precision") * 2.0 * F.col("recall") / F.nullif(both, F.lit(0.0))).otherwise(0.0),
        "missing_ratio": share(p - m, p), "extra_ratio": share(t - m, t), "agreement": F.when((t == 0) & (p == 0), 10.0).otherwise(score),
    }).drop("ious")


def discrepancies(scores: DataFrame) -> DataFrame:
    """Images to review: counts differ by more than 5, or agreement below 5 (DOM-57)."""
    return scores.where((F.abs(F.col("n_truth") - F.col("n_preds")) > 5) | (F.col("agreement") < 5.0))


def confidence_stats(preds: DataFrame) -> DataFrame:
    """Mean, upper median, least and greatest confidence per image (DOM-55, AGG-10)."""
    sorted_ = F.array_sort(F.collect_list("conf"))
    per = preds.groupBy("image_id").agg(F.avg("conf").alias("mean_confidence"), sorted_.alias("all"), F.min("conf").alias("min_confidence"), F.max("conf").alias("max_confidence"))
    return per.withColumn("median_confidence", F.get("all", F.floor(F.size("all") / 2).cast("int"))).drop("all")


def unscored(images: DataFrame, scored: DataFrame) -> DataFrame:
    """Images without stored agreement; resumed runs skip the others (DOM-58)."""
    return images.join(scored.where("mean_confidence is not null").select("image_id"), "image_id", "left_anti")
