"""Statistics, histograms, top-k, samples and the dashboard (AGG-*, SRT-*, WIN-03, WIN-04, DOM-121)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions.policy import class_name


def class_statistics(boxes: DataFrame) -> DataFrame:
    """Boxes, images and share of all boxes by class (AGG-09, WIN-03)."""
    per = boxes.groupBy(class_name(F.col("class_idx")).alias("class_name")).agg(F.count("*").alias("boxes"), F.countDistinct("image_id").alias("images"))
    return per.withColumn("pct", F.round(F.col("boxes") * 100.0 / F.sum("boxes").over(Window.partitionBy()), 6))


def densities(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes per image, 0 included."""
    return images.select("image_id").join(boxes.groupBy("image_id").agg(F.count("*").alias("n")), "image_id", "left").select("image_id", F.coalesce("n", F.lit(0)).alias("n"))


def density_stats(counts: DataFrame) -> DataFrame:
    """Least, greatest, mean and upper median of ``n`` (AGG-10), from a histogram rather than a list of all rows."""
    hist = counts.groupBy("n").agg(F.count("*").alias("c"))
    upto = hist.withColumn("upto", F.sum("c").over(Window.orderBy("n"))).withColumn("total", F.sum("c").over(Window.partitionBy()))
    return upto.agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.round(F.sum(F.col("n") * F.col("c")) / F.sum("c"), 6).alias("mean_n"), F.min(F.when(F.col("upto") > F.floor(F.col("total") / 2), F.col("n"))).alias("median_n"))


def labelled_counts(rows: DataFrame, bins: list[tuple[str, Column]], name: str = "bin") -> DataFrame:
    """Rows by the first bin that holds, empty bins included (AGG-13, AGG-14)."""
    which = None
    for label, when in bins:
        which = F.when(when, label) if which is None else which.when(when, label)
    one = rows.select(which.alias(name)).groupBy(name).agg(F.count("*").alias("n"))
    labels = rows.sparkSession.createDataFrame([(label,) for label, _ in bins], f"{name} string")
    return labels.join(one, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))


def density_histogram(counts: DataFrame) -> DataFrame:
    """Six bins of boxes per image (AGG-14)."""
    n = F.col("n")
    return labelled_counts(counts, [("<=2", n <= 2), ("3-5", n <= 5), ("6-10", n <= 10), ("11-20", n <= 20), ("21-50", n <= 50), (">50", n > 50)])


def score_bins(scored: DataFrame, column: str = "overall") -> DataFrame:
    """Half-open score bins without rejected and duplicate rows (AGG-13)."""
    s, edges = F.col(column), [0, 2, 4, 5, 6, 7, 7.5, 8, 8.5, 9]
    bins = [(f"{lo}-{hi}", (s >= lo) & (s < hi)) for lo, hi in zip(edges, edges[1:])] + [("9-10", s >= 9)]
    return labelled_counts(scored.where(~F.col("status").isin("rejected", "duplicate")), bins)


def box_sizes(boxes: DataFrame) -> DataFrame:
    """Boxes by size class, with tiny and giant ones and the mean area (AGG-15, AGG-08)."""
    area = F.col("w") * F.col("h")
    size = F.when(area < 0.001, "small").when(area <= 0.01, "medium").otherwise("large")
    return boxes.groupBy(size.alias("size_class")).agg(F.count("*").alias("boxes"), F.count_if(area < 0.0001).alias("tiny"), F.count_if(area > 0.30).alias("giant"), F.round(F.sum(area) / F.count("*"), 6).alias("mean_area"))


def percentiles(rows: DataFrame, columns: list[str], by: str, points: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Exact linear-interpolated percentiles (AGG-11), one row a group and metric.

    ``percentile`` counts equal values on the map side, so its buffers grow
    with distinct values, not rows.
    """
    per = rows.groupBy(by).agg(*[F.percentile(c, F.array(*[F.lit(p) for p in points])).alias(c) for c in columns])
    long = per.select(by, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("p")) for c in columns])).alias("x"))
    return long.select(by, "x.metric", *[F.round(F.get("x.p", k), 6).alias(f"p{int(p * 100)}") for k, p in enumerate(points)])


def histogram(rows: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the column's own range; the maximum falls in the last, an empty range is widened (AGG-16)."""
    x = F.col(column)
    ends = rows.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    ends = ends.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    placed = rows.where(x.isNotNull()).join(F.broadcast(ends)).select(F.least(F.floor((x - F.col("lo")) / ((F.col("hi") - F.col("lo")) / float(bins))), F.lit(bins - 1)).cast("long").alias("bin"))
    return placed.groupBy("bin").agg(F.count("*").alias("n"))


def clamped_histogram(rows: DataFrame, column: str, lo: float, hi: float, bins: int = 10) -> DataFrame:
    """Equal-width bins over a given range, values outside in the edge bins (AGG-17)."""
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(column) - lo) / ((hi - lo) / float(bins))))).cast("long")
    return rows.where(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


def top(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows (SRT-03): each task keeps k, the driver merges."""
    return rows.orderBy(*order).limit(k)


def _shuffled(id_column: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def stratified(rows: DataFrame, by: str, id_column: str, k: int, seed: int = 42) -> DataFrame:
    """Up to k rows a group, by seeded hash order (SRT-06)."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(_shuffled(id_column, seed), id_column))
    return rows.withColumn("pick", rank).where(F.col("pick") <= k)


def source_yield(datasets: DataFrame, index: DataFrame) -> DataFrame:
    """Images, accepted and yield by source, sources without images included (JN-02, AGG-06)."""
    per = index.groupBy("dataset_id").agg(F.count("image_id").alias("images"), F.count_if(F.col("status") == "accepted").alias("accepted"))
    out = datasets.join(per, "dataset_id", "left").select("dataset_id", "name", F.coalesce("images", F.lit(0)).alias("images"), F.coalesce("accepted", F.lit(0)).alias("accepted"))
    return out.withColumn("yield_pct", F.round(F.coalesce(F.col("accepted") * 100.0 / F.nullif("images", F.lit(0)), F.lit(0.0)), 6))


def yield_rollup(index: DataFrame) -> DataFrame:
    """Counts by dataset with a Total row (AGG-21)."""
    per = index.rollup("dataset_id").agg(F.count("*").alias("images"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.grouping("dataset_id").alias("g"))
    return per.select(F.when(F.col("g") == 1, "Total").otherwise(F.col("dataset_id")).alias("dataset_id"), "images", "accepted")


def status_pivot(index: DataFrame) -> DataFrame:
    """Images by dataset and status (AGG-02)."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return index.groupBy("dataset_id").agg(*[n(s) for s in ("accepted", "rejected", "ignored", "review", "duplicate")])


def dashboard(index: DataFrame, boxes: DataFrame) -> DataFrame:
    """General figures of the health dashboard (AGG-01..05, AGG-08, TRAP-19)."""
    accepted = index.where("status = 'accepted'").select("image_id")
    curated = boxes.join(accepted, "image_id").agg(F.count("*").alias("curated_boxes"), F.countDistinct("image_id").alias("images_with_boxes"), F.round(F.coalesce(F.sum(F.col("w") * F.col("h")) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 6).alias("mean_area"))
    general = index.agg(
        F.count("*").alias("images"), F.countDistinct("dataset_id").alias("datasets"), F.round(F.coalesce(F.avg("raw_blur"), F.lit(0.0)), 6).alias("mean_blur"),
        F.round(F.coalesce(F.avg("yolo_agreement"), F.lit(0.0)), 6).alias("mean_agreement"), F.round(F.avg(F.when(F.col("status") != "rejected", F.coalesce("f1", F.lit(0.0)))), 6).alias("mean_f1"),
    )
    return general.join(F.broadcast(curated))


def diversity_counts(diversity: DataFrame) -> DataFrame:
    """Images by lighting and by skin tone in one pass (AGG-07)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in ("lighting", "skin_tone")])).alias("x")
    return diversity.select(pairs).groupBy("x.dimension", "x.value").agg(F.count("*").alias("images"))


def false_positive_rates(metrics: DataFrame) -> DataFrame:
    """Shares that a recalibration would give back (AGG-26)."""
    share = lambda c: F.round(F.avg(c.cast("int")) * 100.0, 6)
    return metrics.agg(share((F.col("raw_blur") >= 25) & (F.col("raw_blur") < 80)).alias("blur_fp_pct"), share((F.col("f1") >= 0.50) & (F.col("f1") < 0.85)).alias("f1_fp_pct"))


def retention(index: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes by what became of their image (AGG-22), one join."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    out = boxes.join(index.select("image_id", "status"), "image_id").agg(F.count("*").alias("original"), n("accepted").alias("accepted"), n("review").alias("review"), n("rejected", "duplicate").alias("removed"))
    return out.withColumn("retention_pct", F.round(F.col("accepted") * 100.0 / F.greatest(F.col("original"), F.lit(1)), 6))


def validity(annotations: DataFrame) -> DataFrame:
    """Annotations and valid ones (AGG-03)."""
    return annotations.agg(F.count("*").alias("annotations"), F.coalesce(F.sum("is_valid"), F.lit(0)).cast("long").alias("valid"))


def agreement_means(scores: DataFrame) -> DataFrame:
    """Means over rows that are not rejected, missing values counting as 0, and the mean count difference over all rows (AGG-23)."""
    live = F.col("status") != "rejected"
    mean = lambda c: F.round(F.avg(F.when(live, F.coalesce(c, F.lit(0.0)))), 6)
    apart = F.abs(F.coalesce("n_boxes", F.lit(0)) - F.coalesce("yolo_box_count", F.lit(0)))
    return scores.agg(mean("f1").alias("mean_f1"), mean("missing_ratio").alias("mean_missing_ratio"), mean("mean_confidence").alias("mean_confidence"), F.round(F.avg(apart), 6).alias("mean_count_difference"))


def resolution_summary(images: DataFrame, size: str = "length") -> DataFrame:
    """Bytes and int-truncated mean resolution by dataset (AGG-24)."""
    return images.groupBy("dataset_id").agg(F.sum(size).alias("bytes"), F.avg("width").cast("int").cast("long").alias("mean_width"), F.avg("height").cast("int").cast("long").alias("mean_height"))


def resolution_histogram(images: DataFrame) -> DataFrame:
    """Images by resolution (SRC-19)."""
    return images.groupBy("width", "height").agg(F.count("*").alias("images"))


def random_rows(rows: DataFrame, n: int, seed: int, id_column: str) -> DataFrame:
    """The first n rows by seeded hash of the id (SRT-05), however rows are dealt; each task keeps n."""
    return rows.orderBy(_shuffled(id_column, seed), id_column).limit(n)
