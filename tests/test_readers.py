import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.functions import policy
from quillsieve.operators import agreement, audit, dedup, pixels, release, stats
from quillsieve.sources import readers, sinks


def _png(path, array):
    import struct
    import zlib

    h, w, _ = array.shape
    raw = b"".join(b"\0" + array[i].tobytes() for i in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_yolo_text(spark):
    texts = spark.createDataFrame([("a", "0 0.5 0.5 0.1 0.1\nbad line\n3 .1 .2 .3 .4 0.9\n-1 .1 .1 .1 .1\n0 x .1 .1 .1"), ("b", None), ("c", "")], "image_id string, text string")
    got = [(r.image_id, r.ann_seq, r.class_idx, r.class_name, r.xc) for r in readers.yolo_labels(texts, ("papule", "pustule")).orderBy("image_id", "ann_seq").collect()]
    assert got == [("a", 0, 0, "papule", 0.5), ("a", 1, 3, "class_3", 0.1), ("a", 2, -1, "class_-1", 0.1)]
    bad = {(r.line, r.problem) for r in readers.yolo_problems(spark.createDataFrame([("a", "0 0.5 0.5 0.1 0.1\nbad\n0 1.5 .1 .1 .1\n0 x .1 .1 .1")], "image_id string, text string")).collect()}
    assert bad == {(2, "columns"), (3, "outside"), (4, "not_a_number")}


def test_near_pairs_at_a_threshold_of_16(spark):
    apart = sum(1 << (4 * k) for k in range(16))  # one bit in every four
    rows = spark.createDataFrame([(1, 0), (2, apart), (3, apart | 2)], "image_id long, bits long")
    assert {(r.id_a, r.id_b, r.distance) for r in dedup.near_pairs(rows, threshold=16).collect()} == {(1, 2, 16), (2, 3, 1)}


def test_markdown_report_refuses_what_it_would_cut(spark):
    assert sinks.markdown_report("t", "s", {"x": spark.range(1000)}).count("\n| ") == 1002
    with pytest.raises(ValueError, match="more than 1000 rows"):
        sinks.markdown_report("t", "s", {"x": spark.range(1001)})


def test_coco_ids_hold_within_their_document(spark):
    doc = lambda name, file, x: json.dumps({"categories": [{"id": 1, "name": name}], "images": [{"id": 5, "file_name": f"a/{file}"}], "annotations": [{"image_id": 5, "category_id": 1, "bbox": [x, 0, 64, 64]}]})
    r = readers.coco_labels(spark.createDataFrame([(doc("cat", "p.jpg", 0),), (doc("dog", "q.jpg", 64),)], "text string")).collect()
    assert sorted((b.file_name, b.class_name, round(b.xc, 3)) for b in r) == [("p.jpg", "cat", 0.05), ("q.jpg", "dog", 0.15)]


def test_voc_and_coco(spark):
    xml = "<annotation><size><width>100</width><height>200</height></size><object><name>zit</name><bndbox><xmin>10</xmin><ymin>20</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object><object><name>x</name><bndbox><xmin>0</xmin><ymin>0</ymin><xmax>50</xmax><ymax>50</ymax></bndbox></object></annotation>"
    r = readers.voc_labels(spark.createDataFrame([("a", xml)], "image_id string, text string")).orderBy("ann_seq").first()
    assert (r.class_name, r.xc, r.yc, r.w, r.h) == ("zit", 0.2, 0.2, 0.2, 0.2)
    doc = '{"categories":[{"id":1,"name":"acne"}],"images":[{"id":7,"file_name":"x/y.jpg","width":0,"height":320}],"annotations":[{"image_id":7,"category_id":1,"bbox":[64,32,128,64]},{"image_id":7,"category_id":9,"bbox":[0,0,1]}]}'
    r = readers.coco_labels(spark.createDataFrame([(doc,)], "text string")).collect()
    assert len(r) == 1 and (r[0].file_name, r[0].class_name, r[0].xc, r[0].yc, r[0].w, r[0].h) == ("y.jpg", "acne", 0.2, 0.2, 0.2, 0.2)


def test_files_ids_sidecars_pixels(spark, tmp_path):
    rng = np.random.default_rng(0)
    for split in ("train", "valid"):
        (tmp_path / split / "images").mkdir(parents=True)
        (tmp_path / split / "labels").mkdir()
        for k in range(3):
            _png(tmp_path / split / "images" / f"i{k}.PNG", rng.integers(0, 256, (20 + k, 30, 3), np.uint8))
            (tmp_path / split / "labels" / f"i{k}.txt").write_text("0 .5 .5 .1 .1")
    (tmp_path / "train" / "images" / "broken.jpg").write_bytes(b"no image")
    root = str(tmp_path)
    images = readers.with_ids(readers.files(spark, root), "DS009")
    rows = images.orderBy("path").collect()
    assert [r.image_id for r in rows] == [f"DS009_{k:05d}" for k in range(1, 8)] and {r.split for r in rows} == {"train", "valid"}
    paired = {r.stem: r.label_path for r in readers.sidecars(images, readers.files(spark, root, readers.LABEL_PATTERN)).where("split = 'valid'").collect()}
    assert len(paired) == 3 and all(v.endswith(f"/labels/{k}.txt") for k, v in paired.items())
    got = pixels.measured(readers.pixels(spark, root)).collect()
    assert sum(r.corrupted for r in got) == 1 and all(len(r.dhash) == 16 and r.blur > 0 for r in got if not r.corrupted)


def test_pixel_kernels():
    flat = np.full((10, 12), 40.0)
    assert pixels.laplacian_variance(flat) == 0 and pixels.dhash(flat) == "0" * 16
    ramp = np.tile(np.arange(90, 0, -1.0), (40, 1))
    assert pixels.dhash(ramp) == "f" * 16
    x = np.random.default_rng(1).integers(0, 256, (7, 9)).astype(float)
    at = lambda i, j: x[abs(i) if i < 7 else 12 - i, abs(j) if j < 9 else 16 - j]
    lap = [at(i - 1, j) + at(i + 1, j) + at(i, j - 1) + at(i, j + 1) - 4 * x[i, j] for i in range(7) for j in range(9)]
    assert pixels.laplacian_variance(x) == pytest.approx(np.var(lap))


def test_patch_metrics_equal_kernel(spark):
    v = [float(x) for x in np.random.default_rng(2).normal(size=64)]
    r = pixels.patch_metrics(spark.createDataFrame([(1, v)], "vec_id long, embedding array<float>")).first()
    x = np.array(v, np.float32).astype(float).reshape(8, 8)
    assert r.blur == pytest.approx(pixels.laplacian_variance(x)) and r.mean == pytest.approx(x.mean()) and r.deviation == pytest.approx(x.std())


def test_annotation_payloads(spark):
    rows = [("a", 1, '{"bbox":[0.5,0.5,0.1,0.1]}'), ("a", 2, "{corrupt"), ("b", 1, '{"box":[1]}'), ("c", 1, '{"bbox":[0.1,0.2,0.3]}'), ("d", 1, '{"bbox":[1.5,0.5,0.1,0.1]}'), ("e", 1, '{"bbox":[0.5,0.5,0.1,0.1]}')]
    boxes = audit.annotation_boxes(spark.createDataFrame(rows, "image_id string, ann_seq int, data string"))
    assert [r.payload for r in boxes.orderBy("image_id", "ann_seq").collect()] == ["ok", "corrupt", "no_bbox", "bad_length", "ok", "ok"]
    images = spark.createDataFrame([(x,) for x in "abcdef"], "image_id string")
    got = {r.image_id: (r.verdict, r.n_boxes) for r in audit.image_audit(images, boxes).collect()}
    assert got == {"a": ("rejected", 1), "b": ("rejected", 0), "c": ("rejected", 0), "d": ("rejected", 1), "e": ("pass", 1), "f": ("review", 0)}


def test_greedy_match_against_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    truth = [(i, s, *rng.uniform(0.2, 0.8, 2).round(2).tolist(), 0.3, 0.3) for i in range(30) for s in range(rng.integers(0, 6))]
    preds = [(i, s, 0.5, *rng.uniform(0.2, 0.8, 2).round(2).tolist(), 0.3, 0.3) for i in range(30) for s in range(rng.integers(0, 6))]

    def iou(a, b):
        w = max(0.0, min(a[0] + a[2] / 2, b[0] + b[2] / 2) - max(a[0] - a[2] / 2, b[0] - b[2] / 2))
        h = max(0.0, min(a[1] + a[3] / 2, b[1] + b[3] / 2) - max(a[1] - a[3] / 2, b[1] - b[3] / 2))
        return w * h / (a[2] * a[3] + b[2] * b[3] - w * h)

    want = {}
    for i in {t[0] for t in truth} | {p[0] for p in preds}:
        used, n = set(), 0
        for t in (t for t in truth if t[0] == i):
            best, at = 0.0, None
            for p in (p for p in preds if p[0] == i and p[1] not in used):
                if iou(t[2:], p[3:]) > best:
                    best, at = iou(t[2:], p[3:]), p[1]
            if best >= 0.4:
                used.add(at)
                n += 1
        want[i] = n
    a = spark.createDataFrame(truth, "image_id long, ann_seq int, xc double, yc double, w double, h double")
    b = spark.createDataFrame(preds, "image_id long, pred_seq int, conf double, xc double, yc double, w double, h double")
    scores = agreement.agreement_scores(agreement.greedy_match(a, b)).collect()
    assert {r.image_id: r.matches for r in scores} == want and all(1 <= r.agreement <= 10 for r in scores)


def test_greedy_dedup_against_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(i, str(rng.integers(0, 12)) if i % 3 else f"u{i}", f"{int(rng.integers(0, 4)) * 0x1111:016x}" if i % 2 else f"{int(rng.integers(0, 2**62)):016x}", float(rng.integers(0, 5))) for i in range(60)]
    lost = {}
    for x in range(60):
        for y in range(x + 1, 60):
            if y in lost:
                continue
            near = bin(int(rows[x][2], 16) ^ int(rows[y][2], 16)).count("1") <= 4
            if rows[x][1] == rows[y][1] or near:
                loser = y if rows[x][3] >= rows[y][3] else x
                lost[loser] = lost.get(loser, 0) + 1
    df = spark.createDataFrame(rows, "image_id long, file_hash string, perceptual_hash string, score double").withColumn("bits", dedup.hash_bits(F.col("perceptual_hash")))
    assert {r.image_id: r.times for r in dedup.greedy_local(df).collect()} == lost


def test_invariants(spark):
    rows = spark.range(835).select(F.col("id").alias("image_id"))
    n = {r.split: r["count"] for r in release.split_assignment(rows).groupBy("split").count().collect()}
    assert n == {"train": 584, "val": 125, "test": 126}
    assert policy.LICENCES[0][0] == "mit"
    q = stats.density_stats(spark.createDataFrame([(x,) for x in (5, 1, 9, 7)], "n long")).first()
    assert q.median_n == 7
    with pytest.raises(Exception, match="bad status"):
        spark.createDataFrame([("x",)], "s string").select(policy.valid_status(F.col("s"))).collect()
    got = readers.data_yaml("names:\n  - a\n  - 'b'\nroboflow:\n  project: my-acne-set\n  license: MIT\n")
    assert got == {"names": ["a", "b"], "name": "My Acne Set", "license": "MIT", "url": None}
    assert sinks.changelog("# Log\n\nold", "new").index("new") < sinks.changelog("# Log\n\nold", "new").index("old")
    assert "| a |" in sinks.markdown_report("T", "s", {"x": spark.createDataFrame([("a",)], "c string")})


def test_pipeline_and_stream(spark, tmp_path):
    from quillsieve import catalog
    from quillsieve.plans import stages
    from quillsieve.streaming import ingest

    s = catalog.Source(spark, "/root/testdata/sf0.001")
    out = stages.run(stages.State(s.index, s.boxes, s.preds, s.datasets)).index
    n = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert sum(n.values()) == s.images.count() and set(n) <= set(policy.STATUSES)
    src, manifest = str(tmp_path / "in"), str(tmp_path / "m")
    rows = s.images.select("dataset_id", F.col("image_id").cast("string").alias("relative_path"), F.col("file_hash").alias("sha256"))
    rows.write.parquet(src)
    for _ in range(2):
        ingest.ingest(ingest.arrivals(spark, src, rows.schema), manifest, str(tmp_path / "cp")).awaitTermination()
        rows.limit(5).write.mode("append").parquet(src)
    assert spark.read.parquet(manifest).count() == rows.distinct().count()


def test_command_line(spark, tmp_path):
    from quillsieve import __main__ as cli
    from quillsieve import catalog

    s = catalog.Source(spark, "/root/testdata/sf0.001")
    for name in ("index", "boxes", "preds", "datasets"):
        getattr(s, name).write.parquet(f"{tmp_path}/{name}.parquet")
    for command in ("audit", "agreement", "near", "dashboard", "pipeline"):
        cli.main([command, "--tables", str(tmp_path), "--output", f"{tmp_path}/out-{command}", "--skip", "licence"])
        assert spark.read.parquet(f"{tmp_path}/out-{command}").count() > 0
