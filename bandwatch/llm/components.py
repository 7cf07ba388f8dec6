"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.stage import staged


def _toward_minimum(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over (a, b): every neighbour of an id that is larger (or not larger) than it is tied to the id's least neighbour.

    Minima are partial aggregates and the way back is a join, so an id with very many links is never gathered.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
    tied = both.join(least, "a")
    if larger:
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where(
        "a <> b").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every id is tied to one id, which is tied to none."""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    held = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return held.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of (a, b) links; a component is named by its least id.

    Stars toward larger and smaller neighbours in turn until all ids are tied to a least one, about log(ids)
    rounds. Each round is a written table, so a lost executor costs one round. Self-links and repeated links change
    nothing.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _all_stars(edges):
        edges = staged(_toward_minimum(_toward_minimum(edges, True), False), "stars")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
