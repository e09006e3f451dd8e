"""Operator 9: mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' token shares
are raked: in turn each dimension's marginal is scaled to its target, and no
cell may hold more than all its tokens, which would be a probability above 1.
Not every target can be met by a sample of the wanted size, so raking runs for
several sample sizes at once, ``SHRINK`` apart, and the largest whose marginals
are all within ``TOLERANCE`` of their targets counts.  Where none is (targets
that contradict each other), the one that comes closest counts, with a warning.
A document is then kept with its cell's probability, target tokens over present
tokens.  Chance comes from the document's id, so a rerun keeps the same
documents.  ``achieved`` lists target and expected shares and the size.

Everything is DataFrame expressions.  Documents are read once for the cells and
once for the sample and never shuffled; what is shuffled are cells, and up to
``SMALL_CELLS`` of them are raked in one partition, without shuffles.

Defined results: null source or language is the category ``(none)``; null text
is empty and has weight 0; rows that share an id share their chance; a text of
any length is one row of its cell; targets may name categories that are absent
(they are skipped, the others keep their proportions) and categories without a
target have weight 0; an empty table stays empty; extra columns are kept
apart, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.plans.cut import scratch, written

DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
TURNS, KEEP, SEED = 16, 0.7, "mix-1"
SIZES, SHRINK, TOLERANCE = 10, 0.8, 0.005
SMALL_CELLS, AT_ONCE = 100_000, 8
NONE = "(none)"


def topic_of(text: Column) -> Column:
    """A coarse topic from the kind of content; ``mixed`` takes any other column instead."""
    return (
        F.when(text.contains("|"), "listing").when(text.contains("@"), "contact").when(text.contains("icens"), "legal")
        .when(text.rlike("[0-9]"), "figures").otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """About as many tokens as the packing's tokenizer makes: 0.35 a character and 0.75 more a byte beyond ASCII."""
    return F.ceil((F.length(text) * 35 + (F.octet_length(text) - F.length(text)) * 75) / 100).cast("long")


def _chance(doc_id: Column, seed: str) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(16**13)


def _goals(cells: DataFrame, d: str, targets: Mapping[str, Mapping[str, float]] | None, temper: Mapping[str, float]) -> DataFrame:
    """(d, t_d): the target share of every category that is there."""
    sums = cells.groupBy(d).agg(F.sum("x").cast("double").alias("g"))
    if targets and d in targets:
        pairs = [F.lit(v) for k, share in targets[d].items() for v in (k, float(share))]
        sums = sums.select(d, F.coalesce(F.create_map(*pairs)[F.col(d)], F.lit(0.0)).alias("g"))
    else:
        sums = sums.select(d, F.pow("g", F.lit(temper[d])).alias("g"))
    total = sums.agg(F.sum("g")).first()[0]
    return written(sums.select(d, F.coalesce(F.try_divide("g", F.lit(total).cast("double")), F.lit(0.0)).alias(f"t_{d}")), "goals")


def sizes(keep: float) -> list[float]:
    return [keep * SHRINK**k for k in range(SIZES)]


def _raked(cells: DataFrame, targets, temper: Mapping[str, float], keep: float, turns: int) -> tuple[DataFrame, float, bool]:
    """(cells with t_d, their share ``w`` of the sample), the size that counts, and whether it meets the targets."""
    total = float(cells.agg(F.sum("x")).first()[0] or 0)
    now = cells.withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes(keep)])))
    for d in DIMENSIONS:
        now = now.join(_goals(cells, d, targets, temper), d)
    now = now.withColumns({"w": F.col("x") / total, "most": F.col("x") / (F.col("size") * total)}) if total else now.withColumns({"w": F.lit(0.0), "most": F.lit(0.0)})
    now = written(now, "raking")
    few = cells.count() <= SMALL_CELLS
    for start in range(0, turns, AT_ONCE):
        now = now.coalesce(1) if few else now
        for _ in range(min(AT_ONCE, turns - start)):
            for d in DIMENSIONS:
                share = F.try_divide(F.col("w") * F.col(f"t_{d}"), F.sum("w").over(Window.partitionBy("size", d)))
                now = now.withColumn("w", F.least("most", F.coalesce(share, F.lit(0.0))))
        now = written(now, "raked")
    missed = None
    for d in DIMENSIONS:
        part = now.groupBy("size", d).agg(F.abs(F.sum("w") - F.first(f"t_{d}")).alias("e")).groupBy("size").agg(F.max("e").alias("e"))
        missed = part if missed is None else missed.unionByName(part)
    errors = {r["size"]: r["e"] for r in missed.groupBy("size").agg(F.max("e").alias("e")).collect()}  # a row a size
    met = [size for size, e in errors.items() if e <= TOLERANCE]
    size = max(met) if met else min(errors, key=lambda s: (errors[s], -s)) if errors else keep
    return now.where(F.col("size") == size), size, bool(met) or not errors


def probabilities(cells: DataFrame, targets=None, temper: Mapping[str, float] = TEMPER, keep: float = KEEP, turns: int = TURNS) -> DataFrame:
    """(source, lang, topic, x, w, probability, size) for cells with ``x`` tokens each; ``size`` is the kept share of all tokens."""
    with scratch() as block:
        raked, size, met = _raked(cells.where("x > 0"), targets, temper, keep, turns)
        if not met:
            warnings.warn("no sample size meets all targets; mixing.achieved lists what is reached", stacklevel=2)
        total = raked.agg(F.sum("x")).first()[0] or 0
        chance = F.round(F.least(F.lit(1.0), F.col("w") * float(size * total) / F.col("x")), 9)
        out = written(raked.select(*DIMENSIONS, "x", "w", chance.alias("probability"), "size"), "probabilities")
        block.keep(out)
    return out


def mixed(docs: DataFrame, targets=None, temper: Mapping[str, float] = TEMPER, keep: float = KEEP, turns: int = TURNS, seed: str = SEED, topic: Column | None = None) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with source, lang, topic, tokens, probability and sampled."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cells_of = [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")]
    topic = topic_of(text) if topic is None else F.coalesce(topic.cast("string"), F.lit(NONE))
    keyed = docs.select(F.struct("*").alias("doc"), *cells_of, topic.alias("topic"), tokens_of(text).alias("tokens"), F.col("doc_id").alias("id"))
    cells = written(keyed.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("x")), "cells")
    chance = probabilities(cells, targets, temper, keep, turns).select(*DIMENSIONS, "probability")
    out = keyed.join(chance, list(DIMENSIONS), "left").withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    return out.withColumn("sampled", _chance(F.col("id"), seed) < F.col("probability")).drop("id")


def achieved(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, temper: Mapping[str, float] = TEMPER, **options) -> DataFrame:
    """(dimension, value, target, expected, size): token shares that ``mixed`` aims at and that its probabilities give, and the expected share of all tokens kept."""
    cells = mixed(docs, targets, temper, **options).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("x"), F.sum(F.col("tokens") * F.col("probability")).alias("e"))
    cells = written(cells.where("x > 0"), "achieved")
    whole = cells.agg(F.sum("x").cast("double"), F.sum("e")).first()
    out = None
    for d in DIMENSIONS:
        sums = cells.groupBy(d).agg(F.sum("e").alias("e")).join(_goals(cells, d, targets, temper), d)
        expected = F.coalesce(F.try_divide("e", F.lit(whole[1]).cast("double")), F.lit(0.0))
        part = sums.select(F.lit(d).alias("dimension"), F.col(d).alias("value"), F.col(f"t_{d}").alias("target"), expected.alias("expected"), F.lit((whole[1] or 0.0) / (whole[0] or 1.0)).alias("size"))
        out = part if out is None else out.unionByName(part)
    return out


def sampled_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix keeps, with their own columns."""
    return mixed(docs, **options).where("sampled").select("doc.*")


def oracle(table: str = "documents") -> str:
    """DuckDB SQL of ``mixed`` with the default options, for tables with doc_id, text, lang and source."""
    steps, at = [], "raked0"
    for k in range(TURNS * 3):
        d = DIMENSIONS[k % 3]
        share = f"least(most, coalesce(w * t_{d} / nullif(sum(w) over (partition by size, {d}), 0), 0))"
        steps.append(f"raked{k + 1} as materialized (select source, lang, topic, x, size, most, t_source, t_lang, t_topic, {share} as w from {at})")
        at = f"raked{k + 1}"
    margins = ", ".join(f"m_{d} as (select {d}, pow(sum(x), {TEMPER[d]}) as g from cells group by 1), n_{d} as (select {d}, g / sum(g) over () as t_{d} from m_{d})" for d in DIMENSIONS)
    errors = " union all ".join(f"select size, max(e) as e from (select size, {d}, abs(sum(w) - any_value(t_{d})) as e from {at} group by all) group by size" for d in DIMENSIONS)
    listed = ", ".join(f"({s!r}::double)" for s in sizes(KEEP))
    return f"""
        with docs as (select doc_id, coalesce(source, '{NONE}') as source, coalesce(lang, '{NONE}') as lang, coalesce(text, '') as text from {table}),
        keyed as materialized (
            select doc_id, source, lang, ceil((length(text) * 35 + (strlen(text) - length(text)) * 75) / 100)::bigint as tokens,
                case when contains(text, '|') then 'listing' when contains(text, '@') then 'contact' when contains(text, 'icens') then 'legal'
                    when regexp_matches(text, '[0-9]') then 'figures' else 'prose' end as topic
            from docs
        ), cells as materialized (select source, lang, topic, sum(tokens)::double as x from keyed group by all having sum(tokens) > 0),
        {margins}, sizes(size) as (values {listed}),
        raked0 as materialized (
            select source, lang, topic, x, size, x / (size * (select sum(x) from cells)) as most, t_source, t_lang, t_topic, x / (select sum(x) from cells) as w
            from cells join n_source using (source) join n_lang using (lang) join n_topic using (topic), sizes
        ), {", ".join(steps)},
        errors as (select size, max(e) as e from ({errors}) group by size),
        best as (select size from errors order by e > {TOLERANCE}, case when e > {TOLERANCE} then e else 0 end, size desc limit 1),
        chances as (select source, lang, topic, round(least(1, w * (size * (select sum(x) from cells)) / x), 9) as probability from {at} where size = (select size from best))
        select doc_id, source, lang, topic, tokens, coalesce(probability, 0) as probability,
            ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / {float(16**13)} < coalesce(probability, 0) as sampled
        from keyed left join chances using (source, lang, topic)
    """
