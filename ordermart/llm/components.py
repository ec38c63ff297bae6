"""Connected components of an edge table, as rounds of stars.

Each round links the larger neighbours of every node to its smallest (large
star), then the smaller ones (small star); a few rounds leave one star a
component.  Every round is an aggregation and a join by node, written to the
shared folder; edges never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

MAX_ROUNDS = 60


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v): u > v.  One star step."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    sides = edges.unionByName(turned) if large else edges
    low = sides.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
    if large:  # larger neighbours go to the smallest around
        out = turned.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:  # smaller neighbours and the node itself do
        out = (edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
               .unionByName(low.select("u", F.col("low").alias("v"))))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable, for every node that
    has an edge; ``edges`` has two columns of longs, in any direction."""
    a, b = edges.columns
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    digest = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    seen = tuple(now.agg(*digest).first())
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        now = stage(_stars(_stars(now, True), False), "edges")
        last, seen = seen, tuple(now.agg(*digest).first())
        if last == seen:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
