"""Every registered query of the engine and its DuckDB equivalent.

A query reads whole driver tables, derives the index tables from them
(``sources.fixtures``) and applies library operators; its SQL states the same
result independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions import policy
from quillsieve.functions.geometry import iou_sql
from quillsieve.operators import agreement, audit, dedup, pixels, release, review, scoring, stats
from quillsieve.plans.cut import written
from quillsieve.sources import fixtures as fx
from quillsieve.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WITH = fx.in_duckdb(f"""with fx_datasets as ({fx.DATASETS}), fx_images as ({fx.IMAGES}), fx_boxes as ({fx.BOXES}), fx_preds as ({fx.PREDS}), fx_index as ({fx.INDEX})""")


def query(name: str, sql: str | None = None):
    """Registers a function (views of the engine's tables) -> DataFrame under ``name``."""

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(Source(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = f"{WITH} {sql}" if not sql.lstrip().lower().startswith("with") else f"{WITH}, {sql.lstrip()[4:]}"
        return f

    return register


class Source:
    """The index tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        sql = {"datasets": fx.DATASETS, "images": fx.IMAGES, "boxes": fx.BOXES, "preds": fx.PREDS, "index": fx.INDEX}.get(name)
        return fx.view(self.spark, self.sf_dir, sql) if sql else fx.table(self.spark, self.sf_dir, name)

    @property
    def hashed(self) -> DataFrame:
        return self.images.withColumn("bits", dedup.hash_bits(F.col("perceptual_hash"))).withColumn("score", F.col("raw_blur"))

    @property
    def flags(self) -> DataFrame:
        return audit.annotation_flags(self.boxes)

    @property
    def v1(self) -> DataFrame:
        return scoring.score_v1(self.index, self.flags)

    @property
    def v2(self) -> DataFrame:
        return scoring.score_v2(self.index, self.flags)


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# --- licences, classes ------------------------------------------------------------------------------------------

def _licence_sql() -> str:
    rules = [(f"l = '{key}'", row) for key, *row in policy.LICENCES] + [(f"contains(l, '{key}')", row) for key, *row in policy.LICENCES]
    row = lambda a, c, v: f"struct_pack(a := {a}, c := {c}, v := '{v}')"
    return "case " + " ".join(f"when {when} then {row(*x)}" for when, x in rules) + f" else {row(1, 0, 'review')} end"


_LICENCE = _licence_sql()


@query("license_validation", f"""with l as (select dataset_id, lower(trim(license_type)) as l from fx_datasets), v as (select dataset_id, {_LICENCE} as x from l)
    select dataset_id, x.a::bigint as attribution, x.c::bigint as commercial, x.v as verdict,
      case when x.v = 'review' then 'Flagged: license needs review' else 'Awaiting annotation audit' end as initial_reason from v""")  # fmt: skip
def _(s):
    out = s.datasets.select("dataset_id", policy.licence(F.col("license_type")).alias("x")).select("dataset_id", "x.*")
    return out.withColumn("initial_reason", F.when(F.col("verdict") == "review", "Flagged: license needs review").otherwise("Awaiting annotation audit"))


@query("source_yield", """select d.dataset_id, d.name, count(i.image_id) as images, coalesce(sum(case when i.status = 'accepted' then 1 else 0 end), 0)::bigint as accepted,
    round(coalesce(sum(case when i.status = 'accepted' then 1 else 0 end) * 100.0 / nullif(count(i.image_id), 0), 0)::double, 6) as yield_pct
    from fx_datasets d left join fx_index i using (dataset_id) group by all""")  # fmt: skip
def _(s):
    return stats.source_yield(s.datasets, s.index)


@query("yield_rollup", """select case when grouping(dataset_id) = 1 then 'Total' else dataset_id end as dataset_id, count(*) as images, count_if(status = 'accepted')::bigint as accepted
    from fx_index group by rollup (dataset_id)""")  # fmt: skip
def _(s):
    return stats.yield_rollup(s.index)


_NAME = "case " + " ".join(f"when class_idx = {i} then '{n}'" for i, n in enumerate(policy.CLASSES)) + " else concat('class_', class_idx) end"
_ACTION = "case " + " ".join(f"when class_idx in {v} then '{k}'" for k, v in policy.ACTIONS.items()) + " end"


@query("yolo_index_to_name", f"select class_idx::bigint as class_idx, {_NAME} as class_name, count(*) as boxes from fx_boxes group by all")
def _(s):
    return _long(s.boxes.groupBy("class_idx").agg(F.count("*").alias("boxes")).withColumn("class_name", policy.class_name(F.col("class_idx"))), "class_idx")


_SYN = ", ".join(f"'{x}'" for x in policy.SYNONYMS)


@query("class_harmonization", f"""with raw as (select case p_partkey % 6 when 0 then 'PIMPLES' when 1 then 'acne' when 2 then 'Zit' when 3 then split_part(p_type, ' ', 1) when 4 then 'forehead' else 'rosacea' end as label from part)
    select label, case when label in ({_SYN}) or lower(label) in ({_SYN}) then 'acne' end as target, count(*) as parts from raw group by all""")  # fmt: skip
def _(s):
    k = F.col("p_partkey") % 6
    label = F.when(k == 0, "PIMPLES").when(k == 1, "acne").when(k == 2, "Zit").when(k == 3, F.get(F.split("p_type", " "), 0)).when(k == 4, "forehead").otherwise("rosacea")
    return s.part.select(label.alias("label")).groupBy("label").agg(F.count("*").alias("parts")).withColumn("target", policy.harmonised(F.col("label")))


@query("clinical_action", f"select {_NAME} as class_name, {_ACTION} as action, count(*) as boxes from fx_boxes group by all")
def _(s):
    return audit.clinical_boxes(s.boxes).groupBy("class_name", "action").agg(F.count("*").alias("boxes"))


@query("clinical_image_status", f"""with a as (select image_id, {_ACTION} as action from fx_boxes)
    select image_id, case when max(action = 'REJECT') then 'rejected' when max(action = 'REVIEW') then 'review' else 'unchanged' end as clinical_status from a group by 1""")  # fmt: skip
def _(s):
    return audit.clinical_status(s.boxes)


@query("clinical_retention", f"""with a as (select {_ACTION} as action, count(*) as boxes from fx_boxes group by 1) select action, boxes, round(boxes * 100.0::double / sum(boxes) over (), 6) as pct from a""")
def _(s):
    return audit.clinical_retention(s.boxes)


@query("proposed_mapping", "with m(class_name, proposed) as (values " + ", ".join(f"('{n}', '{a}')" for a, names in policy.PROPOSED.items() for n in names) + f"""),
    a as (select distinct {_NAME} as class_name, {_ACTION} as action from fx_boxes) select class_name, proposed, action, proposed = action as agrees from m join a using (class_name)""")  # fmt: skip
def _(s):
    rows = s.spark.createDataFrame([(n, a) for a, names in policy.PROPOSED.items() for n in names], "class_name string, proposed string")
    used = audit.clinical_boxes(s.boxes).select("class_name", "action").distinct()
    return used.join(F.broadcast(rows), "class_name").select("class_name", "proposed", "action", (F.col("proposed") == F.col("action")).alias("agrees"))


@query("provenance_manifest", f"""with a as (select image_id, {_NAME} as n, {_ACTION} as action from fx_boxes)
    select image_id, array_to_string(list_sort(list_distinct(list(n))), ',') as original_classes,
      coalesce(array_to_string(list_sort(list_distinct(list(n) filter (action in ('KEEP', 'REVIEW')))), ','), '') as kept_classes,
      coalesce(array_to_string(list_sort(list_distinct(list(n) filter (action not in ('KEEP', 'REVIEW')))), ','), '') as removed_classes from a group by 1""")  # fmt: skip
def _(s):
    return audit.provenance(s.boxes)


# --- audit ------------------------------------------------------------------------------------------------------

_FLAGGED = """flagged as (select *, (xc < 0 or xc > 1 or yc < 0 or yc > 1) as centre_outside, (w <= 0 or h <= 0) as degenerate,
    (xc - w / 2e0 < 0 or xc + w / 2e0 > 1 or yc - h / 2e0 < 0 or yc + h / 2e0 > 1) as edge_outside, coalesce(w > 0 and h > 0 and (w / nullif(h, 0) > 5e0 or h / nullif(w, 0) > 5e0), false) as aspect,
    w * h > 0.8e0 as giant, (not w * h > 0.8e0 and w * h < 0.0001e0) as tiny from fx_boxes)"""
_PAIRS = f"""pairs as (select image_id, a_seq, b_seq, iou from (select a.image_id, a.ann_seq as a_seq, b.ann_seq as b_seq, {iou_sql('a.', 'b.')} as iou
    from fx_boxes a join fx_boxes b on a.image_id = b.image_id and a.ann_seq < b.ann_seq) t where iou > 0.85e0)"""
_AUDITED = f"""{_FLAGGED}, {_PAIRS}, per as (select image_id, count(*) as n_boxes, max(centre_outside or degenerate or edge_outside or tiny) as rejecting, max(aspect or giant) as reviewing from flagged group by 1),
    over as (select image_id, count(*) as n_pairs from pairs group by 1),
    audited as (select i.image_id, i.dataset_id, coalesce(n_boxes, 0) as n_boxes, case when coalesce(rejecting, false) then 'rejected'
      when coalesce(reviewing, false) or n_pairs > 0 or n_boxes is null then 'review' else 'pass' end as verdict
      from fx_images i left join per using (image_id) left join over using (image_id))"""


@query("box_flags", f"""with {_FLAGGED} select image_id, ann_seq::bigint as ann_seq, centre_outside, degenerate, edge_outside, aspect, giant, tiny,
    case when centre_outside or degenerate or edge_outside or tiny then 'reject' when aspect or giant then 'review' else 'pass' end as box_verdict from flagged""")  # fmt: skip
def _(s):
    return _long(audit.box_flags(s.boxes).select("image_id", "ann_seq", "centre_outside", "degenerate", "edge_outside", "aspect", "giant", "tiny", "box_verdict"), "ann_seq")


@query("audit_verdict", f"with {_AUDITED} select image_id, dataset_id, n_boxes, verdict from audited")
def _(s):
    return audit.image_audit(s.images, s.boxes).select("image_id", "dataset_id", "n_boxes", "verdict")


@query("audit_summary", f"with {_AUDITED} select verdict, count(*) as images from audited group by 1")
def _(s):
    return audit.audit_summary(audit.image_audit(s.images, s.boxes))


@query("audit_reasons", f"""with {_AUDITED}, listed as (
      select image_id, 0 as part, ann_seq as a, r.k as b, concat(r.n, ' ', ann_seq) as reason from flagged, (values (1, 'centre_outside'), (2, 'degenerate'), (3, 'edge_outside'), (4, 'aspect'), (5, 'giant cluster'), (6, 'tiny')) r(k, n)
      where case r.k when 1 then centre_outside when 2 then degenerate when 3 then edge_outside when 4 then aspect when 5 then giant else tiny end
      union all select image_id, 1, a_seq, b_seq, concat('overlapping ', a_seq, '/', b_seq) from pairs),
    texts as (select image_id, string_agg(reason, '; ' order by part, a, b) as reasons from listed group by 1)
    select image_id, verdict, concat_ws('; ', reasons, case when n_boxes = 0 then 'no boxes' end) as reasons from audited left join texts using (image_id)""")  # fmt: skip
def _(s):
    return audit.image_audit(s.images, s.boxes).select("image_id", "verdict", "reasons")


@query("overlap_pairs", f"with {_PAIRS} select image_id, a_seq::bigint as a_seq, b_seq::bigint as b_seq, round(iou, 6) as iou from pairs")
def _(s):
    return _long(audit.overlap_pairs(s.boxes).withColumn("iou", F.round("iou", 6)), "a_seq", "b_seq")


@query("border_audit", """with b as (select image_id, (xc - w / 2e0 < 0.01e0 or xc + w / 2e0 > 0.99e0 or yc - h / 2e0 < 0.01e0 or yc + h / 2e0 > 0.99e0) as strict,
    ((xc - w / 2e0 <= 0.005e0 or xc + w / 2e0 >= 0.995e0 or yc - h / 2e0 <= 0.005e0 or yc + h / 2e0 >= 0.995e0) and (w > 0.04e0 or h > 0.04e0)) as wide from fx_boxes)
    select case when strict and wide then 'problematic' when strict then 'acceptable' when wide then 'problematic_only' else 'inside' end as border, count(*) as boxes, count(distinct image_id) as images from b group by 1""")  # fmt: skip
def _(s):
    return review.border_audit(s.boxes)


# --- statistics -------------------------------------------------------------------------------------------------


@query("class_statistics", f"""with c as (select {_NAME} as class_name, count(*) as boxes, count(distinct image_id) as images from fx_boxes group by 1)
    select class_name, boxes, images, round(boxes * 100.0::double / sum(boxes) over (), 6) as pct from c""")  # fmt: skip
def _(s):
    return stats.class_statistics(s.boxes)


_COUNTS = "counts as (select i.image_id, count(b.image_id) as n from fx_images i left join fx_boxes b using (image_id) group by 1)"


@query("density_stats", f"with {_COUNTS} select min(n) as min_n, max(n) as max_n, round(avg(n), 6) as mean_n, list_sort(list(n))[(count(*) // 2 + 1)::bigint] as median_n from counts")
def _(s):
    return stats.density_stats(stats.densities(s.images, s.boxes))


@query("density_histogram", f"""with {_COUNTS}, l(bin) as (values ('<=2'), ('3-5'), ('6-10'), ('11-20'), ('21-50'), ('>50')),
    c as (select case when n <= 2 then '<=2' when n <= 5 then '3-5' when n <= 10 then '6-10' when n <= 20 then '11-20' when n <= 50 then '21-50' else '>50' end as bin, count(*) as n from counts group by 1)
    select bin, coalesce(n, 0) as n from l left join c using (bin)""")  # fmt: skip
def _(s):
    return stats.density_histogram(stats.densities(s.images, s.boxes))


@query("densest_topk", f"with {_COUNTS} select image_id, n from counts order by n desc, image_id limit 50")
def _(s):
    return stats.top(stats.densities(s.images, s.boxes), [F.desc("n"), F.col("image_id")], 50)


@query("sparsest_topk", f"with {_COUNTS} select image_id, n from counts order by n, image_id limit 50")
def _(s):
    return stats.top(stats.densities(s.images, s.boxes), [F.col("n"), F.col("image_id")], 50)


@query("box_size_profile", """select case when w * h < 0.001e0 then 'small' when w * h <= 0.01e0 then 'medium' else 'large' end as size_class, count(*) as boxes, count_if(w * h < 0.0001e0)::bigint as tiny,
    count_if(w * h > 0.30e0)::bigint as giant, round(sum(w * h) / count(*), 6) as mean_area from fx_boxes group by 1""")  # fmt: skip
def _(s):
    return stats.box_sizes(s.boxes)


_P = ", ".join(f"round(quantile_cont({{m}}, {p}), 6) as p{int(p * 100)}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))


@query("metric_percentiles", " union all ".join(f"select dataset_id, '{m}' as metric, {_P.format(m=m)} from fx_images group by dataset_id" for m in ("raw_blur", "exposure_pct")))
def _(s):
    return stats.percentiles(s.images, ["raw_blur", "exposure_pct"], "dataset_id")


@query("histogram_equiwidth", """with e as (select min(raw_blur) as lo, max(raw_blur) as hi from fx_images), f as (select case when lo = hi then lo - 0.5e0 else lo end as lo, case when lo = hi then hi + 0.5e0 else hi end as hi from e)
    select least(floor((raw_blur - lo) / ((hi - lo) / 10e0)), 9)::bigint as bin, count(*) as n from fx_images, f group by 1""")  # fmt: skip
def _(s):
    return stats.histogram(s.images, "raw_blur", 10)


@query("histogram_clamped", "select greatest(0, least(19, floor((raw_blur - 20e0) / ((300e0 - 20e0) / 20e0))))::bigint as bin, count(*) as n from fx_images group by 1")
def _(s):
    return stats.clamped_histogram(s.images, "raw_blur", 20.0, 300.0, 20)


_DIVERSE = """diverse as (select image_id, dataset_id, width < 640 or height < 640 as too_small, case when exposure_pct / 100e0 < 0.25e0 then 'low_light' when exposure_pct / 100e0 > 0.75e0 then 'high_exposure' else 'optimal' end as lighting,
    case when exposure_pct / 100e0 > 0.70e0 then 'L1' when exposure_pct / 100e0 > 0.45e0 then 'L2' else 'L3' end as skin_tone from fx_images)"""


@query("resolution_gate", f"with {_DIVERSE} select dataset_id, too_small, count(*) as images from diverse group by all")
def _(s):
    return scoring.diversity(s.images).groupBy("dataset_id", "too_small").agg(F.count("*").alias("images"))


@query("lighting_class", f"with {_DIVERSE} select lighting, count(*) as images from diverse group by all")
def _(s):
    return scoring.diversity(s.images).groupBy("lighting").agg(F.count("*").alias("images"))


@query("skin_class", f"with {_DIVERSE} select skin_tone, count(*) as images from diverse group by all")
def _(s):
    return scoring.diversity(s.images).groupBy("skin_tone").agg(F.count("*").alias("images"))


@query("diversity_counts", f"with {_DIVERSE} select 'lighting' as dimension, lighting as value, count(*) as images from diverse group by all union all select 'skin_tone', skin_tone, count(*) from diverse group by all")
def _(s):
    return stats.diversity_counts(scoring.diversity(s.images))


@query("fp_rates", "select round(avg((raw_blur >= 25 and raw_blur < 80)::int) * 100e0, 6) as blur_fp_pct, round(avg((f1 >= 0.50 and f1 < 0.85)::int) * 100e0, 6) as f1_fp_pct from fx_index")
def _(s):
    return stats.false_positive_rates(s.index)


_V8 = "vec as (select vec_id, list_transform(embedding, lambda x: x::double) as p from embeddings)"


def _lap(r: int, c: int) -> str:
    mirror = lambda k: 1 if k < 0 else 6 if k > 7 else k
    at = lambda i, j: f"p[{mirror(i) * 8 + mirror(j) + 1}]"
    return f"{at(r - 1, c)} + {at(r + 1, c)} + {at(r, c - 1)} + {at(r, c + 1)} - {at(r, c)} * 4e0"


@query("patch_quality", f"""with {_V8}, l as (select vec_id, p, [{", ".join(_lap(r, c) for r in range(8) for c in range(8))}] as l from vec)
    select vec_id, round(list_var_pop(l), 5) as blur, round(list_avg(p), 5) as mean, round(list_stddev_pop(p), 5) as deviation from l""")  # fmt: skip
def _(s):
    out = pixels.patch_metrics(s.embeddings)
    return out.select("vec_id", *[F.round(c, 5).alias(c) for c in ("blur", "mean", "deviation")])


@query("label_text_parse", """select image_id, row_number() over (partition by image_id order by ann_seq) - 1 as ann_seq, class_idx::bigint as class_idx, round(xc, 6) as xc, round(w, 6) as w from fx_boxes where ann_seq <> 3""")
def _(s):
    line = F.concat_ws(" ", "class_idx", "xc", "yc", "w", F.when(F.col("ann_seq") == 3, F.lit("x")).otherwise(F.col("h").cast("string")))
    texts = s.boxes.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("ann_seq", line.alias("line")))).alias("lines"))
    texts = texts.select("image_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))
    out = readers.yolo_labels(texts, policy.CLASSES)
    return _long(out.select("image_id", "ann_seq", "class_idx", F.round("xc", 6).alias("xc"), F.round("w", 6).alias("w")), "ann_seq", "class_idx")


@query("voc_parse", "select image_id, (ann_seq - 1)::bigint as ann_seq, round(((xc - w / 2e0) * 640 + (xc + w / 2e0) * 640) / 2e0 / 640, 5) as xc, round(w, 5) as w from fx_boxes")
def _(s):
    x0, x1 = (F.col("xc") - F.col("w") / 2.0) * 640, (F.col("xc") + F.col("w") / 2.0) * 640
    one = F.concat(*[F.lit("<object><name>"), F.col("class_idx").cast("string"), F.lit("</name><bndbox><xmin>"), x0.cast("string"), F.lit("</xmin><ymin>0</ymin><xmax>"), x1.cast("string"), F.lit("</xmax><ymax>64</ymax></bndbox></object>")])
    texts = s.boxes.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("ann_seq", one.alias("x")))).alias("l"))
    texts = texts.select("image_id", F.concat(F.lit("<annotation>"), F.array_join(F.transform("l", lambda v: v["x"]), ""), F.lit("</annotation>")).alias("text"))
    return _long(readers.voc_labels(texts).select("image_id", "ann_seq", F.round("xc", 5).alias("xc"), F.round("w", 5).alias("w")), "ann_seq")


def _coco(boxes: DataFrame, span: int) -> DataFrame:
    """Boxes a file and class, by COCO documents of the images in ``span`` ids each.

    The documents are written before they are parsed: a collected list has another order whenever its rows arrive in
    another, and categories, images and annotations, which are read apart, must be those of one text.
    """
    one = F.struct("image_id", F.col("class_idx").alias("category_id"), F.array((F.col("xc") - F.col("w") / 2.0) * 640, F.lit(0.0), F.col("w") * 640, F.col("h") * 640).alias("bbox"))
    docs = boxes.groupBy(F.floor(F.col("image_id") / span).alias("bucket")).agg(F.to_json(F.struct(
        F.array(*[F.struct(F.lit(i).alias("id"), F.lit(str(i)).alias("name")) for i in range(15)]).alias("categories"),
        F.collect_set(F.struct(F.col("image_id").alias("id"), F.concat(F.lit("d/"), F.col("image_id").cast("string"), F.lit(".jpg")).alias("file_name"))).alias("images"),
        F.array_sort(F.collect_list(one)).alias("annotations"),
    )).alias("text"))
    docs = written(docs.select("text"), "coco")
    return readers.coco_labels(docs).groupBy("file_name", "class_name").agg(F.count("*").alias("boxes"), F.round(F.sum("w"), 4).alias("sum_w"))


@query("coco_parse", "select concat(image_id, '.jpg') as file_name, class_idx::varchar as class_name, count(*) as boxes, round(sum(w), 4) as sum_w from fx_boxes where image_id % 50 = 7 group by all")
def _(s):
    return _coco(s.boxes.where("image_id % 50 = 7"), 50 * 1024)  # a document holds 1,024 images at most


@query("coco_parse_all", "select concat(image_id, '.jpg') as file_name, class_idx::varchar as class_name, count(*) as boxes, round(sum(w), 4) as sum_w from fx_boxes group by all")
def _(s):
    return _coco(s.boxes, 1024)


# --- agreement --------------------------------------------------------------------------------------------------


@query("greedy_match")
def _(s):
    return agreement.greedy_match(s.boxes, s.preds)


@query("agreement_scores")
def _(s):
    return agreement.agreement_scores(agreement.greedy_match(s.boxes, s.preds))


@query("agreement_discrepancy")
def _(s):
    return agreement.discrepancies(agreement.agreement_scores(agreement.greedy_match(s.boxes, s.preds)))


@query("confidence_stats", """select image_id, round(avg(conf), 6) as mean_confidence, round(list_sort(list(conf))[(count(*) // 2 + 1)::bigint], 6) as median_confidence, round(min(conf), 6) as min_confidence, round(max(conf), 6) as max_confidence
    from fx_preds group by 1""")  # fmt: skip
def _(s):
    out = agreement.confidence_stats(s.preds)
    return out.select("image_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


# --- scoring, bands, review -------------------------------------------------------------------------------------

_FLAGS = f"""{_PAIRS}, flags as (select image_id, count(*) as n_boxes,
      max((xc - w / 2e0 <= 0.005e0 or xc + w / 2e0 >= 1 - 0.005e0 or yc - h / 2e0 <= 0.005e0 or yc + h / 2e0 >= 1 - 0.005e0) and (w > 0.04e0 or h > 0.04e0)) as has_problem_border,
      max(xc - w / 2e0 < 0.01e0 or xc + w / 2e0 > 1 - 0.01e0 or yc - h / 2e0 < 0.01e0 or yc + h / 2e0 > 1 - 0.01e0) as has_border, max(w * h < 0.0001e0) as has_tiny, max(class_idx in (3, 6, 8, 12)) as has_clinical,
      max(exists (select 1 from pairs p where p.image_id = b.image_id)) as has_overlap from fx_boxes b group by 1)"""
_V1 = f"""{_FLAGS}, v1a as (select i.*, coalesce(n_boxes, 0) as n, f.* exclude (image_id, n_boxes), greatest(1e0, least(10e0, coalesce(nullif(raw_blur, 0), 50e0) / 20e0)) as norm_blur,
      greatest(1e0, 10e0 - abs((case when coalesce(nullif(exposure_pct, 0), 127e0) > 10 then coalesce(nullif(exposure_pct, 0), 127e0) / 2.55e0 else coalesce(nullif(exposure_pct, 0), 127e0) end) - 50e0) / 5e0) as norm_exposure,
      greatest(1e0, least(10e0, 10e0 - case when coalesce(n_boxes, 0) > 0 then 0e0 else 3e0 end - case when coalesce(n_boxes, 0) > 40 then 2e0 else 0e0 end
        - case when contains(reason, 'overlapping') then 2e0 else 0e0 end - case when contains(reason, 'cluster') then 1.5e0 else 0e0 end)) as annotation_quality
      from fx_index i left join flags f using (image_id) where status <> 'rejected'),
    v1b as (select *, round((norm_blur * 0.4e0 + norm_exposure * 0.4e0 + (case when width >= 640 and height >= 640 then 10e0 else 5e0 end) * 0.2e0)::varchar::decimal(38, 18), 2)::double as image_quality from v1a),
    v1 as (select *, round(least(10e0, greatest(1e0, image_quality * 0.4e0 + annotation_quality * 0.35e0 + yolo_agreement * 0.25e0))::varchar::decimal(38, 18), 2)::double as overall from v1b),
    r1 as (select *, case when overall < 6 then 'rejected' when status = 'duplicate' then 'duplicate' when regexp_matches(lower(reason), 'flag|discrepancy|blurry|failed|leakage') then 'review' when overall >= 8 then 'accepted' else 'review' end as routed from v1)"""
_V2 = f"""{_FLAGS}, v2a as (select i.*, f.* exclude (image_id), coalesce(has_clinical, false) as clinical, greatest(1e0, least(10e0, raw_blur / 10e0)) as norm_blur,
      greatest(1e0, 10e0 - abs(exposure_pct * 2.55e0 / 2.55e0 - 50e0) / 5e0) as norm_exposure, f1 * 10e0 as agreement,
      10e0 - case when has_overlap then 2e0 else 0e0 end - case when has_tiny then 1e0 else 0e0 end - case when has_problem_border then 2e0 else 0e0 end as annotation_quality
      from fx_index i left join flags f using (image_id) where not (status = 'duplicate' or (status = 'rejected' and contains(lower(reason), 'corruption')))),
    v2b as (select *, round((norm_blur * 0.4e0 + norm_exposure * 0.4e0 + 2e0)::varchar::decimal(38, 18), 2)::double as image_quality from v2a),
    v2 as (select *, round(least(10e0, greatest(1e0, image_quality * 0.4e0 + annotation_quality * 0.35e0 + agreement * 0.25e0))::varchar::decimal(38, 18), 2)::double as overall from v2b),
    w2 as (select *, concat_ws('; ', case when has_overlap then 'overlapping boxes' end, case when has_problem_border then 'problematic border' end, case when has_tiny then 'tiny boxes' end, case when clinical then 'clinical class' end,
      case when agreement < 5 then 'low agreement' end, case when norm_blur < 4 then 'blurry' end, case when norm_exposure < 6 then 'exposure' end) as warnings from v2),
    r2 as (select *, case when overall < 5 then 'rejected' when warnings <> '' then 'review' when overall >= 8 then 'accepted' else 'review' end as routed from w2)"""


@query("scoring_v1", f"""with {_V1} select image_id, n as n_boxes, round(norm_blur, 6) as norm_blur, round(norm_exposure, 6) as norm_exposure, round(annotation_quality, 6) as annotation_quality, image_quality, overall,
    case when n < 5 then 'mild' when n <= 20 then 'moderate' else 'severe' end as severity from v1""")  # fmt: skip
def _(s):
    return s.v1.select("image_id", "n_boxes", *[F.round(c, 6).alias(c) for c in ("norm_blur", "norm_exposure", "annotation_quality")], "image_quality", "overall", "severity")


@query("routing_v1", f"with {_V1} select status, routed, count(*) as images from r1 group by all")
def _(s):
    return scoring.route_v1(s.v1).groupBy("status", "routed").agg(F.count("*").alias("images"))


@query("scoring_v2", f"with {_V2} select image_id, round(norm_blur, 6) as norm_blur, round(norm_exposure, 6) as norm_exposure, round(annotation_quality, 6) as annotation_quality, image_quality, overall from v2")
def _(s):
    return s.v2.select("image_id", *[F.round(c, 6).alias(c) for c in ("norm_blur", "norm_exposure", "annotation_quality")], "image_quality", "overall")


@query("routing_v2", f"with {_V2} select image_id, routed, case when routed = 'accepted' then case when overall >= 9 then 'Gold' else 'Silver' end end as band, warnings from r2")
def _(s):
    return scoring.route_v2(s.v2).select("image_id", "routed", "band", "warnings")


_B5 = "case when routed in ('rejected', 'duplicate') then 'Reject' when overall >= 9 then case when routed = 'review' then 'Review' else 'Gold' end when overall >= 8 then case when routed = 'review' then 'Review' else 'Silver' end when overall >= 7 then case when routed = 'review' then 'Review' else 'Bronze' end when overall >= 5 or routed = 'review' then 'Review' else 'Reject' end"
_B4 = "case when routed in ('rejected', 'duplicate') then 'Reject' when routed = 'review' then 'Review' when overall >= 9 then 'Gold' when overall >= 8 then 'Silver' when overall >= 5 then 'Review' else 'Reject' end"
_BP = "case when routed in ('rejected', 'duplicate') then 'Reject' when routed = 'review' then 'Review' when overall >= 9 then 'Gold' when overall >= 8 then 'Silver' else 'Reject' end"
_BS = "case when overall < 5 then 'Reject' when warnings <> '' then 'Review' when overall >= 9 then 'Gold' when overall >= 8 then 'Silver' else 'Review' end"


@query("bands_5", f"with {_V1} select {_B5} as band, count(*) as images from r1 group by 1")
def _(s):
    return scoring.route_v1(s.v1).groupBy(scoring.band_5(F.col("overall"), F.col("routed")).alias("band")).agg(F.count("*").alias("images"))


@query("bands_4", f"with {_V1} select {_B4} as band, count(*) as images from r1 group by 1")
def _(s):
    return scoring.route_v1(s.v1).groupBy(scoring.band_4(F.col("overall"), F.col("routed")).alias("band")).agg(F.count("*").alias("images"))


@query("bands_pools", f"with {_V1} select {_BP} as band, count(*) as images from r1 group by 1")
def _(s):
    return scoring.route_v1(s.v1).groupBy(scoring.band_pools(F.col("overall"), F.col("routed")).alias("band")).agg(F.count("*").alias("images"))


@query("bands_sim", f"with {_V2} select {_BS} as band, count(*) as images from r2 group by 1")
def _(s):
    return scoring.route_v2(s.v2).groupBy(scoring.band_simulated(F.col("overall"), F.col("warnings") != "").alias("band")).agg(F.count("*").alias("images"))


@query("band_delta", f"""with {_V1}, {'v2a as' + _V2.split(', v2a as', 1)[1]},
    a as (select {_B4} as band, count(*) as n from r1 group by 1), b as (select {_BS} as band, count(*) as n from r2 group by 1)
    select coalesce(a.band, b.band) as band, coalesce(a.n, 0) as current_images, coalesce(b.n, 0) as simulated_images, coalesce(b.n, 0) - coalesce(a.n, 0) as delta from a full join b on a.band = b.band""")  # fmt: skip
def _(s):
    now = scoring.route_v1(s.v1).select(scoring.band_4(F.col("overall"), F.col("routed")).alias("band"))
    then = scoring.route_v2(s.v2).select(scoring.band_simulated(F.col("overall"), F.col("warnings") != "").alias("band"))
    return scoring.band_delta(now, then)


@query("score_bins", f"""with {_V1}, l(bin) as (values ('0-2'), ('2-4'), ('4-5'), ('5-6'), ('6-7'), ('7-7.5'), ('7.5-8'), ('8-8.5'), ('8.5-9'), ('9-10')),
    c as (select case when overall < 2 then '0-2' when overall < 4 then '2-4' when overall < 5 then '4-5' when overall < 6 then '5-6' when overall < 7 then '6-7' when overall < 7.5 then '7-7.5' when overall < 8 then '7.5-8' when overall < 8.5 then '8-8.5' when overall < 9 then '8.5-9' else '9-10' end as bin, count(*) as n
      from r1 where status not in ('rejected', 'duplicate') group by 1) select bin, coalesce(n, 0) as n from l left join c using (bin)""")  # fmt: skip
def _(s):
    return stats.score_bins(s.v1)


_RULES = f"""{_V1}, rules as (select *, [overall < 8 and status <> 'rejected', yolo_agreement < 8 or abs(n - yolo_box_count) > 5, norm_blur < 4, norm_exposure < 6, coalesce(has_overlap, false), coalesce(has_border, false), coalesce(has_tiny, false), coalesce(has_clinical, false), status = 'duplicate'] as r,
    {list(review.RULES)} as names from r1)"""


@query("rule_contributions", f"""with {_RULES}, e as (select unnest(names) as rule, unnest(r) as hit from rules)
    select rule, count_if(hit)::bigint as images, round(count_if(hit) * 100.0::double / (select count(*) from rules), 6) as pct from e group by 1""")  # fmt: skip
def _(s):
    return review.rule_contributions(review.rule_flags(s.v1))


@query("single_vs_multiple", f"""with {_RULES}, a as (select lower(reason) as t, list_filter(list_transform(range(1, 10), lambda i: case when r[i] then names[i] end), lambda x: x is not null) as active from rules where status = 'review')
    select case when len(active) > 1 then 'Multiple reasons' when len(active) = 1 then active[1] when contains(t, 'below auto-accept') then 'Low score' when contains(t, 'yolo agreement') then 'YOLO disagreement'
      when contains(t, 'clinical class') or contains(t, 'contains class') then 'Clinical class review' when contains(t, 'overlap') then 'Annotation overlap' else 'Low score' end as review_reason, count(*) as images from a group by 1""")  # fmt: skip
def _(s):
    return review.single_or_multiple(review.rule_flags(s.v1))


_REASONS = f"""{_V1}, reasons as (select image_id, list_filter([case when has_clinical then 'Clinical_Review' end, case when missing_ratio >= 0.4e0 then 'Missing_Annotations' end,
    case when f1 < 0.5e0 or abs(n - yolo_box_count) > 5 then 'High_Model_Disagreement' end, case when mean_confidence > 0 and mean_confidence < 0.4e0 then 'Low_Model_Confidence' end, case when has_border then 'Border_Issues' end,
    case when norm_blur < 4 or norm_exposure < 6 then 'Image_Quality' end], lambda x: x is not null) as active from r1 where status = 'review')"""


@query("review_reasons", f"with {_REASONS} select image_id, coalesce(active[1], 'Image_Quality') as primary_reason, case when len(active) > 1 then array_to_string(active[2:], ',') else 'None' end as secondary_reasons from reasons")
def _(s):
    return review.reasons(s.v1).select("image_id", "primary_reason", "secondary_reasons")


@query("review_combinations", f"""with {_REASONS}, c as (select case when len(active) > 0 then array_to_string(active, ' + ') else 'Unknown' end as combination, count(*) as images from reasons group by 1)
    select combination, images, round(images * 100.0::double / sum(images) over (), 6) as pct from c""")  # fmt: skip
def _(s):
    return review.combinations(review.reasons(s.v1))


@query("review_categories", f"with {_REASONS} select unnest(case when len(active) = 0 then ['Image_Quality'] else active end) as category, image_id from reasons")
def _(s):
    return review.categories(review.reasons(s.v1))


@query("visual_bands", """select image_id, case when raw_blur >= 200 then 'high' when raw_blur between 20 and 40 then 'medium' when raw_blur < 10 then 'low' end as blur_band,
    case when exposure_pct * 2.55e0 between 110 and 140 then 'good' when exposure_pct * 2.55e0 between 70 and 90 or exposure_pct * 2.55e0 between 180 and 210 then 'fair' when exposure_pct * 2.55e0 < 40 or exposure_pct * 2.55e0 > 230 then 'poor' end as exposure_band,
    case when f1 >= 0.85e0 then 'high' when f1 between 0.50e0 and 0.65e0 then 'medium' when f1 < 0.30e0 then 'low' end as f1_band from fx_index""")  # fmt: skip
def _(s):
    return review.visual_bands(s.index)


@query("status_reset", "select case when status = 'duplicate' or (status = 'rejected' and reason like 'Annotation audit%') then status else 'review' end as status, count(*) as images from fx_index group by 1")
def _(s):
    return review.reset_statuses(s.index).groupBy("status").agg(F.count("*").alias("images"))


@query("review_queue", """select d.doc_id, d.source, l.quality::bigint as quality, l.toxic::bigint as toxic from documents d join labels l using (doc_id) where l.quality = 0 or l.toxic = 1""")
def _(s):
    rows = s.documents.select("doc_id", "source").join(s.labels, "doc_id").withColumn("status", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "review").otherwise("accepted"))
    return _long(review.queue(rows).select("doc_id", "source", "quality", "toxic"), "quality", "toxic")


@query("review_resolve", """select i.image_id, case when image_id % 7 = 3 and status = 'review' then 'accepted' else status end as status, case when image_id % 7 = 3 and status = 'review' then 'Manually resolved' else reason end as reason from fx_index i""")
def _(s):
    index = s.index
    decisions = review.queue(index).where("image_id % 7 = 3").select("image_id", F.lit("accepted").alias("decision"), F.lit(None).cast("string").alias("why"))
    return review.resolve(index, decisions).select("image_id", "status", "reason")


# --- duplicates -------------------------------------------------------------------------------------------------

_BITS = "bits as (select image_id, dataset_id, file_hash, raw_blur as score, ('0x' || substr(perceptual_hash, 1, 8))::bigint as hi, ('0x' || substr(perceptual_hash, 9, 8))::bigint as lo from fx_images)"
_NEAR = "near as (select a.image_id as id_a, b.image_id as id_b, (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::bigint as distance from bits a join bits b on a.image_id < b.image_id and bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 4)"


@query("exact_duplicates", """with g as (select file_hash, min_by(image_id, (-raw_blur, image_id)) as master, count(*) as copies from fx_images group by 1 having count(*) > 1)
    select image_id, file_hash, master, copies, image_id <> master as is_duplicate from fx_images join g using (file_hash)""")  # fmt: skip
def _(s):
    return dedup.exact_groups(s.images, "file_hash", "image_id", [-F.col("raw_blur")])


@query("exact_dup_documents", """with g as (select md5(text) as digest, min(doc_id) as master, count(*) as copies from documents group by 1 having count(*) > 1)
    select doc_id, digest, master, copies, doc_id <> master as is_duplicate from (select doc_id, md5(text) as digest from documents) d join g using (digest)""")  # fmt: skip
def _(s):
    return dedup.exact_groups(s.documents.select("doc_id", F.md5("text").alias("digest")), "digest", "doc_id", [])


@query("near_duplicate_pairs", f"with {_BITS}, {_NEAR} select id_a, id_b, distance from near")
def _(s):
    return dedup.near_pairs(s.hashed)


@query("duplicate_pairs", f"""with {_BITS}, {_NEAR}, e as (select a.image_id as id_a, b.image_id as id_b from bits a join bits b on a.file_hash = b.file_hash and a.image_id < b.image_id)
    select id_a, id_b, 'exact' as match_type from e union all select id_a, id_b, 'near' from near where (id_a, id_b) not in (select id_a, id_b from e)""")  # fmt: skip
def _(s):
    return dedup.duplicate_pairs(s.hashed)


@query("greedy_dedup")
def _(s):
    return dedup.greedy_local(s.hashed)


@query("cross_dataset_dups", f"""with {_BITS}, m as (select c.image_id, c.score, l.image_id as lid, l.score as lscore from bits c join bits l on c.dataset_id = 'DS002' and l.dataset_id <> 'DS002'
      and (c.file_hash = l.file_hash or bit_count(xor(c.hi, l.hi)) + bit_count(xor(c.lo, l.lo)) <= 4)), f as (select image_id, any_value(score) as score, min(lid) as matched_id, min_by(lscore, lid) as lscore from m group by 1)
    select image_id, matched_id, case when score >= lscore then matched_id else image_id end as demoted_id from f""")  # fmt: skip
def _(s):
    rows = s.hashed
    return dedup.cross_dataset(rows.where("dataset_id = 'DS002'"), rows.where("dataset_id <> 'DS002'"))


@query("earliest_master", "select image_id, dataset_id, file_hash, file_hash is null or row_number() over (partition by file_hash order by dataset_id, image_id) = 1 as kept from fx_images")
def _(s):
    return dedup.earliest_master(s.images)


_VEC = "vec as (select vec_id, list_sum(list_transform(range(1, 33), lambda i: case when embedding[i] > embedding[i % 64 + 1] then (1::bigint << (i - 1)::int) else 0 end))::bigint as lo, list_sum(list_transform(range(33, 65), lambda i: case when embedding[i] > embedding[i % 64 + 1] then (1::bigint << (i - 33)::int) else 0 end))::bigint as hi from embeddings)"


@query("vector_dhash", f"with {_VEC} select vec_id, lo, hi from vec")
def _(s):
    out = dedup.sign_hash(s.embeddings)
    return out.select("vec_id", F.col("bits").bitwiseAND(F.lit(0xFFFFFFFF)).alias("lo"), F.shiftrightunsigned("bits", 32).alias("hi"))


@query("vector_near_pairs", f"with {_VEC} select a.vec_id as id_a, b.vec_id as id_b, (bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi)))::bigint as distance from vec a join vec b on a.vec_id < b.vec_id and bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi)) <= 12")
def _(s):
    return dedup.near_pairs(dedup.sign_hash(s.embeddings), "vec_id", "bits", 12)


@query("vector_near_pairs_16", f"with {_VEC} select a.vec_id as id_a, b.vec_id as id_b, (bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi)))::bigint as distance from vec a join vec b on a.vec_id < b.vec_id and bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi)) <= 16")
def _(s):
    return dedup.near_pairs(dedup.sign_hash(s.embeddings), "vec_id", "bits", 16)


# --- release ----------------------------------------------------------------------------------------------------

_SPLIT = "split as (select *, row_number() over (order by md5('42:' || image_id), image_id) as rk, count(*) over () as total from fx_images), tagged as (select *, case when rk <= floor(total * 0.7e0) then 'train' when rk <= floor(total * 0.7e0) + floor(total * 0.15e0) then 'val' else 'test' end as split from split)"


@query("split_assignment", f"with {_SPLIT} select image_id, split from tagged")
def _(s):
    return release.split_assignment(s.images).select("image_id", "split")


@query("split_leakage", f"""with {_SPLIT}, b as (select image_id, file_hash, split, ('0x' || substr(perceptual_hash, 1, 8))::bigint as hi, ('0x' || substr(perceptual_hash, 9, 8))::bigint as lo from tagged)
    select x.image_id as id_a, y.image_id as id_b from b x join b y on x.image_id < y.image_id and x.split <> y.split and (x.file_hash = y.file_hash or bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 4)""")  # fmt: skip
def _(s):
    return release.leakage(release.split_assignment(s.hashed))


@query("benchmark_contamination", "select d.doc_id, b.item_id from documents d join benchmark b on d.text = b.text")
def _(s):
    b = s.benchmark.select("item_id", F.md5("text").alias("digest"))
    return s.documents.select("doc_id", F.md5("text").alias("digest")).join(b, "digest").select("doc_id", "item_id")


_LB = "lb as (select *, least(640e0 / width, 640e0 / height) as scale from fx_images), fit as (select image_id, width, height, scale, floor(width * scale) as nw, floor(height * scale) as nh, floor((640 - floor(width * scale)) / 2e0) as px, floor((640 - floor(height * scale)) / 2e0) as py from lb)"


@query("letterbox_images", f"with {_LB} select nw::bigint as new_w, nh::bigint as new_h, px::bigint as pad_x, py::bigint as pad_y, count(*) as images from fit group by all")
def _(s):
    return release.letterboxed(s.images).groupBy("new_w", "new_h", "pad_x", "pad_y").agg(F.count("*").alias("images"))


@query("letterbox_boxes", f"""with {_LB} select b.image_id, ann_seq::bigint as ann_seq, round(least(1e0, greatest(0e0, (xc * width * scale + px) / 640e0)), 6) as xc, round(least(1e0, greatest(0e0, (yc * height * scale + py) / 640e0)), 6) as yc,
    round(least(1e0, greatest(0e0, w * width * scale / 640e0)), 6) as w, round(least(1e0, greatest(0e0, h * height * scale / 640e0)), 6) as h from fx_boxes b join fit using (image_id)""")  # fmt: skip
def _(s):
    out = release.letterboxed_boxes(s.images, s.boxes)
    return _long(out.select("image_id", "ann_seq", *[F.round(c, 6).alias(c) for c in ("xc", "yc", "w", "h")]), "ann_seq")


@query("fingerprint_sorted", "select dataset_id, sha256(string_agg(file_hash, '' order by file_hash)) as fingerprint, count(*) as files from fx_images group by 1")
def _(s):
    return release.fingerprint(s.images, "file_hash", ["dataset_id"])


_ORD = "case split_tag when 'F' then 0 when 'O' then 1 else 2 end"


@query("fingerprint_ordered", f"select dataset_id, sha256(string_agg(file_hash, '' order by {_ORD}, image_id)) as fingerprint, count(*) as files from fx_images group by 1")
def _(s):
    order = F.when(F.col("split_tag") == "F", 0).when(F.col("split_tag") == "O", 1).otherwise(2)
    return release.fingerprint(s.images, "file_hash", ["dataset_id"], [order.alias("o"), F.col("image_id").alias("i")])


def _manifest(s):
    rows = s.images.select("dataset_id", F.concat(F.lit("images/"), F.col("image_id").cast("string")).alias("relative_path"), F.col("file_hash").alias("sha256"), "image_id")
    return rows.where("image_id % 2 = 0"), rows.where("image_id % 3 = 0")


@query("manifest_sync", "select dataset_id, concat('images/', image_id) as relative_path, file_hash as sha256 from fx_images where image_id % 3 = 0 and image_id % 2 <> 0")
def _(s):
    return release.sync(*_manifest(s)).select("dataset_id", "relative_path", "sha256")


@query("manifest_upsert", "select dataset_id, concat('images/', image_id) as relative_path, case when image_id % 3 = 0 then null else 'old' end as note from fx_images where image_id % 3 = 0 or image_id % 2 = 0")
def _(s):
    old, new = _manifest(s)
    return release.upsert(old.withColumn("note", F.lit("old")), new, ["dataset_id", "relative_path", "sha256"]).select("dataset_id", "relative_path", "note")


@query("keyed_update", "select image_id, case when image_id % 4 = 0 then 'resolved' else status end as status, f1 from fx_index")
def _(s):
    index = s.index.select("image_id", "status", "f1")
    return release.keyed_update(index, index.where("image_id % 4 = 0").select("image_id", F.lit("resolved").alias("status")), "image_id")


@query("pairing_check", """select o_orderkey as stem, 'missing_label' as problem from orders where o_orderkey not in (select l_orderkey from lineitem) group by all
    union all select l_orderkey, 'orphan_label' from lineitem where l_orderkey not in (select o_orderkey from orders) group by all""")  # fmt: skip
def _(s):
    return release.pairing(s.orders.select(F.col("o_orderkey").alias("stem")), s.lineitem.select(F.col("l_orderkey").alias("stem")))


@query("dataset_health", """with a as (select o_custkey as stem, count(*) as files from orders group by 1), b as (select c_custkey as stem, count(*) as label_files, max(c_nationkey = 0) as empty from customer where c_custkey % 5 <> 0 group by 1)
    select count_if(files is not null)::bigint as image_stems, count_if(label_files is null)::bigint as missing_labels, count_if(files is null)::bigint as orphan_labels, count_if(coalesce(empty, false))::bigint as empty_labels, count_if(files > 1)::bigint as duplicate_names from a full join b using (stem)""")  # fmt: skip
def _(s):
    labels = s.customer.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("stem"), F.col("c_nationkey").alias("size"))
    return release.health(s.orders.select(F.col("o_custkey").alias("stem")), labels)


@query("split_duplicates", "select o_custkey as stem, count(distinct o_orderstatus) as splits from orders group by 1 having count(distinct o_orderstatus) > 1")
def _(s):
    return release.split_duplicates(s.orders.select(F.col("o_custkey").alias("stem"), F.col("o_orderstatus").alias("split")))


_SUMMARY = """summary as (select dataset_id, count(*) as ingested, count_if(status = 'accepted')::bigint as accepted, count_if(status = 'review')::bigint as review, count_if(status in ('rejected', 'duplicate'))::bigint as reject,
    round(count_if(status = 'accepted') * 100.0::double / count(*), 6) as acceptance_pct, round(coalesce(avg(case when status = 'accepted' then yolo_box_count end), 0), 6) as mean_detector_boxes from fx_index group by 1)"""


@query("processing_summary", f"with {_SUMMARY} select * from summary")
def _(s):
    return release.processing_summary(s.index)


@query("cumulative_dashboard", f"""with {_SUMMARY}, t as (select concat('DS', lpad(cast(i as varchar), 3, '0')) as dataset_id from range(1, 8) r(i))
    select dataset_id, coalesce(ingested, 0) as ingested, coalesce(accepted, 0) as accepted, coalesce(review, 0) as review, coalesce(reject, 0) as reject, case when ingested is null then 'pending' else 'done' end as state from t left join summary using (dataset_id)""")  # fmt: skip
def _(s):
    return release.cumulative(s.index, s.spark.range(1, 8).select(F.format_string("DS%03d", "id").alias("dataset_id")))


@query("label_files", f"""select image_id, string_agg(printf('%d %.6f %.6f %.6f %.6f', class_idx, xc, yc, w, h), chr(10) order by ann_seq) as label_text from fx_boxes group by 1""")
def _(s):
    return release.yolo_lines(audit.clinical_boxes(s.boxes), policy.CLASSES).select("image_id", "label_text")


@query("stratified_sample", "select dataset_id, image_id, pick from (select dataset_id, image_id, row_number() over (partition by dataset_id order by md5(concat('42:', image_id)), image_id) as pick from fx_images) where pick <= 20")
def _(s):
    return stats.stratified(s.images, "dataset_id", "image_id", 20).select("dataset_id", "image_id", "pick")


# --- dashboard --------------------------------------------------------------------------------------------------


@query("dashboard_general", """with g as (select count(*) as images, count(distinct dataset_id) as datasets, round(coalesce(avg(raw_blur), 0), 6) as mean_blur, round(coalesce(avg(yolo_agreement), 0), 6) as mean_agreement,
      round(avg(case when status <> 'rejected' then f1 end), 6) as mean_f1 from fx_index),
    c as (select count(*) as curated_boxes, count(distinct image_id) as images_with_boxes, round(coalesce(sum(w * h) / nullif(count(*), 0), 0), 6) as mean_area from fx_boxes where image_id in (select image_id from fx_index where status = 'accepted'))
    select * from g, c""")  # fmt: skip
def _(s):
    return stats.dashboard(s.index, s.boxes)


@query("status_pivot", "select dataset_id, " + ", ".join(f"count_if(status = '{x}')::bigint as {x}" for x in ("accepted", "rejected", "ignored", "review", "duplicate")) + " from fx_index group by 1")
def _(s):
    return stats.status_pivot(s.index)


@query("retention", """select count(*) as original, count_if(status = 'accepted')::bigint as accepted, count_if(status = 'review')::bigint as review, count_if(status in ('rejected', 'duplicate'))::bigint as removed,
    round(count_if(status = 'accepted') * 100.0::double / greatest(count(*), 1), 6) as retention_pct from fx_boxes join fx_index using (image_id)""")  # fmt: skip
def _(s):
    return stats.retention(s.index, s.boxes)


@query("merged_uniques", "select count(distinct file_hash) as unique_hashes, array_to_string(list_sort(list_distinct(list(dataset_id))), ',') as datasets from fx_images")
def _(s):
    return s.images.agg(F.countDistinct("file_hash").alias("unique_hashes"), F.array_join(F.array_sort(F.collect_set("dataset_id")), ",").alias("datasets"))


@query("semi_annotations", "select count(*) as boxes from fx_boxes where image_id in (select image_id from fx_index where status not in ('rejected', 'duplicate'))")
def _(s):
    live = s.index.where(~F.col("status").isin("rejected", "duplicate")).select("image_id")
    return s.boxes.join(live, "image_id", "left_semi").agg(F.count("*").alias("boxes"))


@query("like_filters", "select status, count(*) as images from fx_index where (reason like '%audit%' and reason not like 'Failed%') or regexp_matches(lower(reason), 'flag|discrepancy|blurry|failed|leakage') group by 1")
def _(s):
    warned = F.lower("reason").rlike("flag|discrepancy|blurry|failed|leakage")
    return s.index.where((F.col("reason").like("%audit%") & ~F.col("reason").like("Failed%")) | warned).groupBy("status").agg(F.count("*").alias("images"))


@query("event_props", "select (props::json->>'k')::bigint as k, count(*) as events from events group by 1")
def _(s):
    return s.events.select(F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("k").agg(F.count("*").alias("events"))


@query("annotation_validity", "select count(*) as annotations, coalesce(sum(case when h > 0 then 1 else 0 end), 0)::bigint as valid from fx_boxes")
def _(s):
    return stats.validity(s.boxes.withColumn("is_valid", (F.col("h") > 0).cast("int")))


@query("agreement_means", """with n as (select image_id, count(*) as n from fx_boxes group by 1)
    select round(avg(case when status <> 'rejected' then f1 end), 6) as mean_f1, round(avg(case when status <> 'rejected' then missing_ratio end), 6) as mean_missing_ratio,
      round(avg(case when status <> 'rejected' then mean_confidence end), 6) as mean_confidence, round(avg(abs(coalesce(n, 0) - yolo_box_count)), 6) as mean_count_difference from fx_index left join n using (image_id)""")  # fmt: skip
def _(s):
    counts = s.boxes.groupBy("image_id").agg(F.count("*").alias("n_boxes"))
    return stats.agreement_means(s.index.join(counts, "image_id", "left"))


@query("resolution_summary", "select dataset_id, sum(width * height)::bigint as bytes, trunc(avg(width))::bigint as mean_width, trunc(avg(height))::bigint as mean_height from fx_images group by 1")
def _(s):
    return stats.resolution_summary(s.images.withColumn("length", (F.col("width") * F.col("height")).cast("long")))


@query("resolution_histogram", "select width::bigint as width, height::bigint as height, count(*) as images from fx_images group by all")
def _(s):
    return _long(stats.resolution_histogram(s.images), "width", "height")


@query("gold_silver_union", f"with {_V2} select image_id, case when overall >= 9 then 'Gold' else 'Silver' end as band from r2 where routed = 'accepted'")
def _(s):
    routed = scoring.route_v2(s.v2).select("image_id", "band")
    return routed.where("band = 'Gold'").unionByName(routed.where("band = 'Silver'"))


@query("resume_unscored", "select image_id from fx_images where image_id % 4 <> 0")
def _(s):
    stored = s.index.select("image_id", F.when(F.col("image_id") % 4 == 0, F.col("mean_confidence")).alias("mean_confidence"))
    return agreement.unscored(s.images.select("image_id"), stored)


@query("random_sample", "select image_id, dataset_id from fx_images order by md5(concat('42:', image_id)), image_id limit 50")
def _(s):
    return stats.random_rows(s.images.select("image_id", "dataset_id"), 50, 42, "image_id")
