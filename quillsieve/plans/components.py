"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.plans.cut import scratch, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is its smallest node.

    Every node holds a parent, at first its smallest neighbour.  In a turn it
    takes the smallest grandparent among its own and its neighbours', so paths
    halve and stars meet in a few turns, until no parent changes.  Each turn is
    one job, written to the shared folder: a lost executor costs one turn, and
    nothing is gathered on the driver but a count.  A star's hub is one key of
    plain sort-merge joins over rows of two ids, which adaptive execution splits.
    Loops, repeats and either direction are allowed; nulls are ignored.
    """
    with scratch() as block:
        tidy = edges.where("u <> v").select("u", "v")
        tidy = written(tidy.unionByName(tidy.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
        rows = tidy.count()
        now, changed = written(tidy.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p")).withColumn("moved", F.lit(True)), "parents", rows), rows
        while changed:
            with scratch() as turn:
                grand = now.select("u", "p").join(now.select(F.col("u").alias("p"), F.col("p").alias("g")), "p", "left").select("u", "p", F.coalesce("g", "p").alias("g"))
                around = tidy.join(grand.select(F.col("u").alias("v"), "g"), "v").select("u", F.lit(None).cast(grand.schema["p"].dataType).alias("p"), "g")
                least = around.unionByName(grand).groupBy("u").agg(F.min("g").alias("g"), F.min("p").alias("p"))
                now = written(least.select("u", F.col("g").alias("p"), (F.col("g") != F.col("p")).alias("moved")), "parents", rows)
                turn.keep(now)
            changed = now.where("moved").count()
        block.keep(now)
    return now.select(F.col("u").alias("node"), F.col("p").alias("component"))
