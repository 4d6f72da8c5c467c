"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.staging import Staging


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: per node u, link neighbours to the smallest of u and its neighbours.

    The large star links the neighbours above u, the small star u and those below. Node minima are aggregates, and a node
    with very many neighbours meets its minimum in a join that Spark can split.
    """
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node it is linked with, itself included.

    Each round is written to the staging folder, so no lineage grows. Loops and repeated edges do no harm; no edges give
    no rows. Nodes may be of any type that orders; nulls must not be among them.
    """
    edges = staging.write(edges.select("u", "v").where("u <> v").distinct(), f"{name}-0")
    before, turn = None, 0
    while True:
        turn += 1
        edges = staging.write(_star(_star(edges, large=True), large=False), f"{name}-{turn}")
        # Done when nothing changed: a digest of the edges that ignores their order.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
