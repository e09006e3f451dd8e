"""Label, image, manifest and metadata readers (SRC-01..19)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.functions.geometry import corners_to_centre, xywh_to_centre
from quillsieve.functions.policy import class_name, split_tag

IMAGE_PATTERN = r"(?i)\.(jpg|jpeg|png|bmp)$"
LABEL_PATTERN = r"(?i)\.(txt|xml|json)$"


def files(spark: SparkSession, root: str, pattern: str = IMAGE_PATTERN, content: bool = False) -> DataFrame:
    """Files below ``root``: path, directory, stem, extension, split, length (SRC-01, SRC-02, SRC-16); content only on request."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("path").rlike(pattern))
    name = F.element_at(F.split("path", "/"), -1)
    out = found.select(
        "path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"),
        F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("extension"), split_tag(F.col("path")).alias("split"), "length", *(["content"] if content else []),
    )
    return out


def hashed_files(spark: SparkSession, root: str, pattern: str = IMAGE_PATTERN) -> DataFrame:
    """Files with md5 and sha256 of their bytes (SRC-16, hash functions)."""
    return files(spark, root, pattern, content=True).withColumns({"file_hash": F.md5("content"), "sha256": F.sha2("content", 256)}).drop("content")


def with_ids(found: DataFrame, dataset_id: str) -> DataFrame:
    """Surrogate ids ``<dataset>_<00000>`` in path order (SRC-03).

    Positions come from sorted ranges: each range is numbered on its own and
    shifted by the rows before it, so no task sees all files.
    """
    parts = found.rdd.getNumPartitions()
    ranged = found.repartitionByRange(max(1, parts), "path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id())
    n = ranged.groupBy("part").agg(F.count("*").alias("n"), F.min("path").alias("lo"))
    before = n.select("lo", (F.sum("n").over(Window.orderBy("lo")) - F.col("n")).alias("before"), F.lead("lo").over(Window.orderBy("lo")).alias("hi"))
    joined = found.join(F.broadcast(before), (F.col("path") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("path") < F.col("hi"))))
    rank = F.row_number().over(Window.partitionBy("lo").orderBy("path")) + F.col("before")
    return joined.select(F.format_string("%s_%05d", F.lit(dataset_id), rank.cast("long")).alias("image_id"), *found.columns)


def sidecars(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images with their label file: same folder first, else the sibling ``labels`` folder (SRC-04)."""
    own = labels.groupBy("directory", "stem").agg(F.min("path").alias("label_path"))
    beside = F.regexp_replace("directory", "/[^/]*$", "/labels")
    return (
        images.join(own.withColumnRenamed("label_path", "own_label"), ["directory", "stem"], "left").withColumn("beside", beside)
        .join(own.select(F.col("directory").alias("beside"), "stem", F.col("label_path").alias("other_label")), ["beside", "stem"], "left")
        .withColumn("label_path", F.coalesce("own_label", "other_label")).drop("beside", "own_label", "other_label")
    )


def _lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    return texts.select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("line", "raw")).withColumn("parts", F.split(F.trim(F.regexp_replace("raw", r"\s+", " ")), " "))


def _floats() -> list[Column]:
    return [F.expr(f"try_cast(get(parts, {k}) as double)") for k in range(1, 5)]


def yolo_labels(texts: DataFrame, names: tuple[str, ...], key: str = "image_id", text: str = "text") -> DataFrame:
    """Boxes of YOLO / Darknet label text; bad lines are skipped, ordinals count parsed boxes (SRC-05, WIN-01)."""
    index = F.expr("try_cast(get(parts, 0) as int)")
    rows = _lines(texts, key, text).where(F.size("parts") >= 5).select(key, "line", index.alias("class_idx"), *[c.alias(n) for c, n in zip(_floats(), ("xc", "yc", "w", "h"))])
    rows = rows.where("class_idx is not null and xc is not null and yc is not null and w is not null and h is not null")
    seq = F.row_number().over(Window.partitionBy(key).orderBy("line")) - 1
    return rows.select(key, seq.alias("ann_seq"), "class_idx", class_name(F.col("class_idx"), names).alias("class_name"), "xc", "yc", "w", "h")


def yolo_problems(texts: DataFrame, key: str = "image_id", text: str = "text") -> DataFrame:
    """Line-numbered problems of label text: too few columns, values that do not parse, values outside [0, 1] (SRC-06)."""
    xs = _floats()
    bad = F.expr("try_cast(get(parts, 0) as int)").isNull()
    outside = F.lit(False)
    for x in xs:
        bad, outside = bad | x.isNull(), outside | (x < 0) | (x > 1)
    problem = F.when(F.size("parts") < 5, "columns").when(bad, "not_a_number").when(outside, "outside")
    return _lines(texts, key, text).where(F.trim("raw") != "").select(key, (F.col("line") + 1).alias("line"), problem.alias("problem")).where("problem is not null")


VOC = "size struct<width: double, height: double>, object array<struct<name: string, bndbox: struct<xmin: double, ymin: double, xmax: double, ymax: double>>>"


def voc_labels(texts: DataFrame, key: str = "image_id", text: str = "text") -> DataFrame:
    """Boxes of VOC XML; a missing or zero size is 640 (SRC-07, DOM-04)."""
    doc = texts.select(key, F.from_xml(F.col(text), VOC).alias("d"))
    size = lambda c: F.coalesce(F.nullif(F.col(f"d.size.{c}"), F.lit(0.0)), F.lit(640.0))
    rows = doc.select(key, size("width").alias("W"), size("height").alias("H"), F.posexplode("d.object").alias("ann_seq", "o"))
    b = F.col("o.bndbox")
    return rows.select(key, "ann_seq", F.col("o.name").alias("class_name"), *corners_to_centre(b.xmin, b.ymin, b.xmax, b.ymax, F.col("W"), F.col("H")))


COCO = (
    "categories array<struct<id: long, name: string>>, images array<struct<id: long, file_name: string, width: double, height: double>>, "
    "annotations array<struct<image_id: long, category_id: long, bbox: array<double>>>"
)


def coco_labels(documents: DataFrame, text: str = "text") -> DataFrame:
    """Boxes of COCO documents by base name; size 640 where missing or 0 (SRC-08, JN-06, JN-15, DOM-05).

    Image and category ids hold within their document; rows of equal text are one document.
    """
    doc = documents.select(F.col(text).alias("text")).distinct().select(F.md5("text").alias("doc"), F.from_json("text", COCO).alias("d"))
    names = doc.select("doc", F.explode("d.categories").alias("c")).select("doc", F.col("c.id").alias("category_id"), "c.name")
    size = lambda c: F.coalesce(F.nullif(F.col(f"i.{c}"), F.lit(0.0)), F.lit(640.0)).alias(c)
    images = doc.select("doc", F.explode("d.images").alias("i")).select("doc", F.col("i.id").alias("image_id"), F.element_at(F.split("i.file_name", "/"), -1).alias("file_name"), size("width"), size("height"))
    boxes = doc.select("doc", F.posexplode("d.annotations").alias("ann_seq", "a")).where(F.size("a.bbox") == 4).select("doc", "ann_seq", "a.image_id", "a.category_id", "a.bbox")
    out = boxes.join(images, ["doc", "image_id"]).join(names, ["doc", "category_id"], "left")
    label = F.coalesce("name", F.concat(F.lit("class_"), F.col("category_id").cast("string")))
    return out.select("file_name", "ann_seq", label.alias("class_name"), *xywh_to_centre(*[F.get("bbox", k) for k in range(4)], F.col("width"), F.col("height")))


def class_list(value: str | None, lines: list[str] | None = None) -> tuple[str, ...]:
    """Class names from a comma list, else from the lines of classes.txt (SRC-09)."""
    if value:
        return tuple(x.strip() for x in value.split(",") if x.strip())
    return tuple(x.strip() for x in lines or [] if x.strip())


def data_yaml(text: str) -> dict:
    """names, project title, licence and url of a ``data.yaml`` (SRC-10, SRC-11); the few keys that are used, no YAML library."""
    out: dict = {"names": [], "name": None, "license": None, "url": None}
    section = None
    for line in text.splitlines():
        if found := re.match(r"^(\w+):\s*(.*)$", line):
            section = found[1]
            if section == "names" and found[2].startswith("["):
                out["names"] = [x.strip().strip("'\"") for x in found[2].strip("[] ").split(",") if x.strip()]
        elif section == "names" and (found := re.match(r"^\s*(?:-|\d+:)\s*(.+)$", line)):
            out["names"].append(found[1].strip().strip("'\""))
        elif section == "roboflow" and (found := re.match(r"^\s+(project|license|url):\s*(.+)$", line)):
            value = found[2].strip().strip("'\"")
            out["name" if found[1] == "project" else found[1]] = value.replace("-", " ").title() if found[1] == "project" else value
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest CSV; its key is dataset_id, relative_path, sha256 (SRC-14)."""
    return spark.read.option("header", "true").csv(path)


def tracker_rows(lines: DataFrame) -> DataFrame:
    """Cells of the rows of a Markdown table with six cells or more (SRC-15)."""
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = lines.where(F.trim("value").startswith("|")).select(cells.alias("cells"))
    return rows.where((F.size("cells") >= 6) & ~F.get("cells", 0).rlike("^:?-+:?$"))


def pixels(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images as BGR bytes (SRC-17); files that do not decode have height -1."""
    kinds = "*.{jpg,jpeg,png,bmp,JPG,JPEG,PNG,BMP}"
    return spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", kinds).load(root).select("image.*")
