"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.operators.joins import keyed_join

from .shared import stage

MAX_ROUNDS = 40


def _star(pairs: DataFrame) -> DataFrame:
    """Point each ``v`` of the rows ``u, v`` at the smallest of u and its v's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return keyed_join(pairs, least, ["u"], "inner").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _star(down)
    return (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(met.select("u", F.col("m").alias("v"))).where("u != v").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``u, v`` edges of one orderable type -> ``node, label``, where the label
    is the smallest node of the component.

    Nodes without an edge to another node have no row. Every round is written to
    the shared folder; only a count and a checksum of it reach the driver.
    """
    edges = stage(edges.where("u != v").select("u", "v").distinct(), "llm-edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = stage(_small_star(_large_star(edges)), "llm-stars")
        sign = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sign == seen:
            break
        seen = sign
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
