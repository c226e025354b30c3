"""Connected components by alternating large-star and small-star rounds.

Every round is joins and map-side-combined minima over the edge table, written
to the shared folder before the next one; a hub's edges stay spread (the join
on the hub can be split by AQE), nothing is collected but one row of sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import drop_written, written


def _sums(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each node of an edge with the smallest node it
    reaches. Null ends and self links are ignored; an empty table gives none."""
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a != b")
    e = written(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    sums = _sums(e)
    while sums[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        new = written(small.where("u != v").distinct(), "edges")
        drop_written(e)
        e, before = new, sums
        sums = _sums(e)
        if sums == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
