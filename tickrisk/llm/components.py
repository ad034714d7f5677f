"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.plans.materialize import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node reachable.

    Each round links every node's larger neighbours to its smallest one, then every
    node's smaller neighbours, until the edges no longer change. Rounds are written to
    the shared folder, so the plan stays short and a lost executor costs one round.
    Minima are aggregated before the shuffle; joins are plain equi-joins, which adaptive
    execution splits where one node has very many edges.
    """
    e = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct(), "edges")
    total = _sum(e)
    while True:
        both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy(F.col("x").alias("u")).agg(F.least(F.min("y"), F.col("u")).alias("m"))
        large = (both.where("y > x").join(least, F.col("x") == F.col("u"))
                 .select(F.col("y").alias("x"), F.col("m").alias("y")).distinct())
        least = large.groupBy(F.col("x").alias("u")).agg(F.min("y").alias("m"))
        small = large.join(least, F.col("x") == F.col("u"))
        after = materialize(
            small.where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
            .unionByName(least.select(F.col("u").alias("x"), F.col("m").alias("y")))
            .where("x != y").distinct(), "edges")
        before, total = total, _sum(after)
        if total == before:
            roots = after.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        e = after


def joined_components(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after ``links`` (a, b) came to the components ``roots``: the links are taken
    between components, so only those that join two are worked on."""
    if roots is None:
        return materialize(connected_components(links), "roots")

    def of(name):
        return roots.select(F.col("node").alias(name), F.col("root").alias(f"r{name}"))

    ends = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    over = materialize(connected_components(ends).select("node", F.col("root").alias("further")), "over")
    moved = (roots.join(over.select(F.col("node").alias("root"), "further"), "root", "left")
             .select("node", F.coalesce("further", "root").alias("root")))
    fresh = over.join(roots.select("node"), "node", "left_anti").select("node", F.col("further").alias("root"))
    return materialize(moved.unionByName(fresh), "roots")


def _sum(e: DataFrame) -> tuple:
    """Row count and an order-free checksum."""
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
