"""Splits, leakage, export geometry, fingerprints, sync and verification (DOM-110..119, AGG-18, AGG-19, SNK-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions.geometry import letterbox, reproject
from quillsieve.functions.policy import DEFAULT, Policy
from quillsieve.operators.dedup import near_pairs


def split_assignment(rows: DataFrame, id_column: str = "image_id", policy: Policy = DEFAULT, seed: str = "42") -> DataFrame:
    """train, val or test by rank of a seeded hash (WIN-06): sizes int(n * r), the rest to test (DOM-110, TRAP-20).

    The cut-off hashes come from the counts of hash ranges, so no task sorts
    the whole table: only the two ranges a cut falls into are ranked.
    """
    keyed = rows.withColumn("h", F.md5(F.concat(F.lit(seed + ":"), F.col(id_column).cast("string")))).withColumn("range", F.substring("h", 1, 3))
    counts = keyed.groupBy("range").agg(F.count("*").alias("n"))  # 4096 ranges at most
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("range")) - F.col("n")).withColumn("total", F.sum("n").over(Window.partitionBy()))
    ranked = keyed.join(F.broadcast(before.select("range", "before", "total")), "range")
    rank = F.row_number().over(Window.partitionBy("range").orderBy("h", id_column)) + F.col("before")
    a, b = policy.splits
    first, second = F.floor(F.col("total") * a), F.floor(F.col("total") * a) + F.floor(F.col("total") * b)
    return ranked.select(*rows.columns, F.when(rank <= first, "train").when(rank <= second, "val").otherwise("test").alias("split"))


def leakage(rows: DataFrame, threshold: int = DEFAULT.hamming) -> DataFrame:
    """Pairs of equal or near hashes across splits (DOM-111); any row means the export must stop."""
    near = near_pairs(rows, threshold=threshold, side="split").select("id_a", "id_b")
    a, b = (rows.select("file_hash", F.col("image_id").alias(f"id_{s}"), F.col("split").alias(f"split_{s}")) for s in "ab")
    exact = a.join(b, "file_hash").where("id_a < id_b and split_a <> split_b").select("id_a", "id_b")
    return near.unionByName(exact).distinct()


def require_no_leakage(rows: DataFrame) -> DataFrame:
    """``rows``, or an error if any pair leaks."""
    found = leakage(rows).take(1)
    if found:
        raise ValueError(f"split leakage: {found[0].id_a} and {found[0].id_b}")
    return rows


def letterboxed(images: DataFrame, side: int = 640) -> DataFrame:
    """Scale, new size and padding of each image (DOM-112)."""
    return images.select("image_id", *[c.alias(k) for k, c in letterbox(F.col("width"), F.col("height"), side).items()])


def letterboxed_boxes(images: DataFrame, boxes: DataFrame, side: int = 640) -> DataFrame:
    """Boxes in the letterboxed image (DOM-113)."""
    joined = boxes.join(images.select("image_id", "width", "height"), "image_id")
    return joined.select("image_id", "ann_seq", *reproject(*[F.col(c) for c in ("xc", "yc", "w", "h", "width", "height")], side))


def yolo_lines(boxes: DataFrame, targets: tuple[str, ...], name_column: str = "class_name") -> DataFrame:
    """Label text per image and the labels outside the target classes (SNK-03, TRAP-16)."""
    index = F.array_position(F.array(*[F.lit(t) for t in targets]), F.col(name_column)) - 1
    line = F.format_string("%d %.6f %.6f %.6f %.6f", index, "xc", "yc", "w", "h")
    per = boxes.groupBy("image_id").agg(F.array_sort(F.collect_list(F.when(index >= 0, F.struct("ann_seq", line.alias("line"))))).alias("lines"), F.collect_set(F.when(index < 0, F.col(name_column))).alias("bad"))
    return per.select("image_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("label_text"), F.array_sort("bad").alias("unexpected_labels"))


def fingerprint(rows: DataFrame, value: str, by: list[str], order: list[Column] | None = None) -> DataFrame:
    """sha256 of a group's concatenated values, sorted or in ``order`` (AGG-18, AGG-19, DOM-114).

    The digest is defined over one string, so a group's hashes meet in one
    task: 32 bytes a row of one release, not of the lake.
    """
    entry = F.struct(*(order or []), F.col(value).alias("v"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["v"]), "")
    return rows.groupBy(*by).agg(F.sha2(text, 256).alias("fingerprint"), F.count("*").alias("files"))


KEY = ("dataset_id", "relative_path", "sha256")


def sync(manifest: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows to add: those whose key the manifest lacks (JN-13, DOM-116); running it twice adds nothing."""
    return incoming.join(manifest.select(*KEY), list(KEY), "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of equal keys; columns a new row lacks become null (SNK-01, SET-04, SET-05)."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def keyed_update(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``rows`` with the non-null columns of ``changes`` put in by key (SNK-02)."""
    columns = [c for c in changes.columns if c != key]
    named = changes.select(key, *[F.col(c).alias(f"{c}__new") for c in columns])
    out = rows.join(named, key, "left")
    return out.withColumns({c: F.coalesce(f"{c}__new", *([c] if c in rows.columns else [])) for c in columns}).drop(*[f"{c}__new" for c in columns])


def pairing(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Stems without their other half (JN-12, SET-01); both have a column ``stem``."""
    a, b = images.select("stem").distinct(), labels.select("stem").distinct()
    missing = a.join(b, "stem", "left_anti").select("stem", F.lit("missing_label").alias("problem"))
    return missing.unionByName(b.join(a, "stem", "left_anti").select("stem", F.lit("orphan_label").alias("problem")))


def split_duplicates(files: DataFrame) -> DataFrame:
    """Stems present in more than one split (WIN-02)."""
    return files.groupBy("stem").agg(F.countDistinct("split").alias("splits")).where("splits > 1")


def health(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts a dataset's health report has (SRC-19, DOM-115): one full outer join on the stem."""
    a = images.groupBy("stem").agg(F.count("*").alias("files"))
    b = labels.groupBy("stem").agg(F.count("*").alias("label_files"), F.max(F.col("size") == 0).alias("empty"))
    both = a.join(b, "stem", "full")
    return both.agg(
        F.count_if(F.col("files").isNotNull()).alias("image_stems"), F.count_if(F.col("label_files").isNull()).alias("missing_labels"), F.count_if(F.col("files").isNull()).alias("orphan_labels"),
        F.count_if(F.coalesce("empty", F.lit(False))).alias("empty_labels"), F.count_if(F.col("files") > 1).alias("duplicate_names"),
    )


def processing_summary(index: DataFrame) -> DataFrame:
    """Counts by status, acceptance and mean detector count of accepted images by dataset (DOM-117, DOM-118, TRAP-18)."""
    n = lambda s: F.count_if(F.col("status") == s)
    return index.groupBy("dataset_id").agg(
        F.count("*").alias("ingested"), n("accepted").alias("accepted"), n("review").alias("review"), (n("rejected") + n("duplicate")).alias("reject"),
        F.round(n("accepted") * 100.0 / F.count("*"), 6).alias("acceptance_pct"),
        F.round(F.coalesce(F.avg(F.when(F.col("status") == "accepted", F.col("yolo_box_count"))), F.lit(0.0)), 6).alias("mean_detector_boxes"),
    )


def cumulative(index: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target dataset with its counts, or pending (DOM-119)."""
    out = F.broadcast(targets).join(processing_summary(index), "dataset_id", "left")
    return out.select("dataset_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("ingested", "accepted", "review", "reject")], F.when(F.col("ingested").isNull(), "pending").otherwise("done").alias("state"))
