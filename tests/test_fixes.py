import os

import numpy as np
import pytest

from quillsieve import catalog
from quillsieve.operators import audit, dedup, scoring, stats


def test_a_missing_hash_equals_nothing(spark):
    rows = [(1, "a", None), (2, "a", None), (3, "b", None), (4, "b", "x"), (5, "a", "x"), (6, "a", "y")]
    got = {r.image_id: r.kept for r in dedup.earliest_master(spark.createDataFrame(rows, "image_id int, dataset_id string, file_hash string")).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: True, 6: True}


def test_audit_reasons_lower_the_first_score(spark):
    boxes = [(1, 0, 0.5, 0.5, 0.3, 0.3), (1, 1, 0.5, 0.5, 0.3, 0.29), (2, 0, 0.5, 0.5, 0.9, 0.9), (3, 0, 0.5, 0.5, 0.3, 0.3)]
    boxes = spark.createDataFrame(boxes, "image_id int, ann_seq int, xc double, yc double, w double, h double")
    images = spark.createDataFrame([(i,) for i in (1, 2, 3)], "image_id int")
    index = audit.image_audit(images, boxes).selectExpr("image_id", "'review' as status", "reasons as reason", "100D as raw_blur", "50D as exposure_pct", "800 as width", "800 as height", "10D as yolo_agreement")
    flags = boxes.groupBy("image_id").count().withColumnRenamed("count", "n_boxes")
    got = {r.image_id: r.annotation_quality for r in scoring.score_v1(index, flags).collect()}
    assert got == {1: 8.0, 2: 8.5, 3: 10.0}


def test_random_rows_do_not_depend_on_partitions(spark):
    rows = spark.range(1000)
    assert {r.id for r in stats.random_rows(rows.repartition(7), 20, 1, "id").collect()} == {r.id for r in stats.random_rows(rows.coalesce(1), 20, 1, "id").collect()}


def test_coco_parse_reads_one_text_of_each_document(spark, monkeypatch):
    def mixed(batches):  # rows arrive in another order each time they are read
        for b in batches:
            yield b.take(np.random.default_rng(int.from_bytes(os.urandom(4))).permutation(b.num_rows))

    rows = [(i, i % 15, 0.5, 0.5, 0.25, 0.1) for i in range(7, 120_000, 50)]
    boxes = spark.createDataFrame(rows, "image_id long, class_idx int, xc double, yc double, w double, h double")
    monkeypatch.setattr(catalog.Source, "boxes", boxes.mapInArrow(mixed, boxes.schema), raising=False)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = catalog.QUERIES["coco_parse"](spark, "").collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert sorted((r.file_name, r.class_name, r.boxes, r.sum_w) for r in got) == sorted((f"{i}.jpg", str(c), 1, 0.25) for i, c, *_ in rows)


@pytest.mark.parametrize("threshold", [12, 16])
def test_near_pairs_compares_blocks_where_bands_are_narrow(spark, monkeypatch, threshold):
    rng = np.random.default_rng(3)
    codes = rng.integers(-(2**63), 2**63, 700)
    flips = np.array([np.bitwise_or.reduce(np.int64(1) << rng.permutation(64)[:k].astype(np.int64)) for k in rng.integers(1, 20, 700)])
    codes = [int(c) for c in np.concatenate([codes, codes ^ flips, codes[:50], [0, -1, 1, -(2**63)]])]
    rows = [(k, c) for k, c in enumerate(codes)] + [(3, codes[3]), (3, codes[3 + 700]), (None, codes[5]), (9000, None)]  # an id twice, with one hash and another
    whole = [(i, c) for i, c in rows if i is not None and c is not None]
    want = sorted((i, j, d) for i, a in whole for j, b in whole if i < j and (d := ((a ^ b) & (2**64 - 1)).bit_count()) <= threshold)
    monkeypatch.setattr(dedup, "BLOCK", 200, raising=False)
    got = dedup.near_pairs(spark.createDataFrame(rows, "id long, bits long").repartition(3), "id", "bits", threshold)
    assert "band" not in got._jdf.queryExecution().toString()  # 64 / 13 bits: hashes that share a band are strangers
    assert sorted((r.id_a, r.id_b, r.distance) for r in got.collect()) == want
    assert len(want) > 300 and dedup.near_pairs(spark.createDataFrame([], "id long, bits long"), "id", "bits", threshold).count() == 0
