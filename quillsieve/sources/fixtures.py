"""The engine's index tables derived from the driver tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DATASETS = """
    select concat('DS', lpad(cast(n_nationkey + 1 as string), 3, '0')) as dataset_id, n_name as name,
      case n_nationkey % 6 when 0 then 'MIT' when 1 then 'CC-BY-4.0' when 2 then 'CC BY 4.0'
        when 3 then 'cc-by-nc-4.0' when 4 then ' Apache-2.0 ' else 'bsd-3-clause' end as license_type
    from {nation} where n_nationkey < 5
"""

IMAGES = """
    select o_orderkey as image_id,
      concat('DS', lpad(cast(o_custkey % 5 + 1 as string), 3, '0')) as dataset_id,
      md5(concat(cast(o_custkey as string), '|', o_orderpriority, '|', cast(month(o_orderdate) as string))) as file_hash,
      concat(substr(md5(cast(case when o_custkey % 10 = 0 then o_orderkey - o_orderkey % 3 else o_orderkey end as string)), 1, 15),
        cast(o_orderkey % 3 as string)) as perceptual_hash,
      case when o_orderkey % 50 = 0 then 416 else 640 end as width, 640 as height,
      o_totalprice / 1000e0 as raw_blur,
      (o_orderkey * 37 % 1000) / 10e0 as exposure_pct,
      o_orderstatus as split_tag
    from {orders}
"""

BOXES = """
    select image_id, ann_seq, class_idx, k, conf,
      case when giant then 0.5e0 when tiny then 0.3e0 else xc0 end as xc,
      case when giant then 0.5e0 when tiny then 0.3e0 else yc0 end as yc,
      case when giant then 0.95e0 when tiny then 0.005e0 else w0 end as w,
      case when giant then 0.95e0 when tiny then 0.005e0 when degen then 0e0 else h0 end as h
    from (select l_orderkey as image_id,
        row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as ann_seq,
        cast(l_partkey % 15 as int) as class_idx,
        (l_partkey % 8 + 1) / 9e0 as xc0, (l_suppkey % 8 + 1) / 9e0 as yc0,
        ceil(l_quantity / 10e0) * 0.05e0 as w0,
        (cast(round(l_extendedprice * 100) as bigint) % 5 + 1) * 0.04e0 as h0,
        (l_linenumber = 7 and round(l_tax * 100) = 8) as giant,
        (l_linenumber = 1 and round(l_discount * 100) = 10) as tiny,
        (cast(round(l_extendedprice * 100) as bigint) % 97 = 0) as degen,
        cast(l_suppkey % 4 as int) as k,
        0.25e0 + (l_partkey % 75) / 100e0 as conf
      from {lineitem}) t
"""

PREDS = f"""
    select image_id, ann_seq as pred_seq, conf,
      xc + case k when 0 then 0.005e0 when 1 then 0.02e0 else 0.3e0 end as xc, yc, w, h
    from ({BOXES}) b where k <> 2
"""

#: Index rows with agreement figures and an earlier status, for scoring and review.
INDEX = f"""
    select i.*,
      (image_id * 17 % 101) / 100e0 as f1, (image_id * 13 % 91) / 10e0 + 1e0 as yolo_agreement,
      image_id % 12 as yolo_box_count, (image_id * 7 % 80) / 100e0 as mean_confidence, (image_id * 11 % 100) / 100e0 as missing_ratio,
      case image_id % 20 when 0 then 'duplicate' when 1 then 'rejected' when 2 then 'accepted' else 'review' end as status,
      case image_id % 20 when 1 then 'Corrupted image file - unreadable by decoder' when 3 then 'Annotation audit flag: overlapping boxes'
        when 4 then 'Annotation audit flag: potential cluster box' when 5 then 'Score below auto-accept' when 6 then 'Failed annotation audit'
        when 7 then 'YOLO discrepancy' else 'Passed annotation audit - Awaiting image metrics' end as reason
    from ({IMAGES}) i
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def in_spark(sql: str, sf_dir: str) -> str:
    return sql.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES})


def in_duckdb(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(in_spark(sql, sf_dir))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
