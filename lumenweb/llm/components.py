"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenweb.llm.common import materialize


def _attach_min(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Both sides are plain scans, so that a node with very many edges is a join that AQE can split."""
    return edges.join(materialize(least, "cc-min"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _attach_min(both, least).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _attach_min(down, least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: u long, v long, u != v. Returns (u, v): each node but a component's smallest, with that smallest node."""
    edges = materialize(edges.where("u != v").distinct(), "cc-edges")
    seen = None
    while True:
        print_ = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_ == seen or print_[0] == 0:
            return edges
        seen = print_
        edges = materialize(_small_star(materialize(_large_star(edges), "cc-large")), "cc-small")
