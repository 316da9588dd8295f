"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v.

    Every node u finds the smallest node m next to it or itself; its larger neighbours (large) or its smaller
    ones and itself (small) are then linked to m. The minimum is pre-aggregated before it is shuffled and the join is a
    plain equi-join, so Spark can split a hub's edges over many tasks.
    """
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = around.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v), both bigint; component is the smallest node reachable.

    Loops and repeated edges are allowed; an edge with a null end is ignored. The result is empty when there are no edges. Rounds end when
    an order-free digest of the edges no longer changes.
    """
    edges = edges.filter("u is not null and v is not null and u != v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct()
    edges, last = checkpoint(edges), None
    while True:
        edges = checkpoint(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            break
        last = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
