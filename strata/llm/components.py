"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .io import stage

#: Neighbours of a node above which its edges are dealt to several tasks.
HUB = 100_000


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either the centre of a star or one of its points: then
    each centre, the smaller end of all its edges, is its component's smallest node."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("centre"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("points"), F.lit(1).alias("centre"))))
    return (ends.groupBy("node").agg(F.sum("points").alias("points"), F.max("centre").alias("centre"))
            .where("points > 0 and points + centre > 1").count() == 0)


def _with_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, m) with the smallest neighbour of every node, and the edges (u, v, m)
    joined with it; the edges of a node of many neighbours are salted."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("k"))
    # No more rows than edges / HUB.
    hubs = least.where(F.col("k") > HUB).select("u", F.ceil(F.col("k") / HUB).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    dealt = edges.join(F.broadcast(hubs), "u", "left").select(
        "u", "v", F.pmod(F.xxhash64("v"), salts).cast("int").alias("salt"))
    spread = least.withColumn("salts", F.ceil(F.greatest(F.col("k"), F.lit(1)) / HUB).cast("int")).select(
        "u", "m", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return least.select("u", "m"), dealt.join(spread, ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; ``root`` is the smallest
    node of the component.

    Each round replaces the edges by the large-star and then the small-star of
    every node (minimum of the neighbourhood, map-side combined).  Edges meet
    their node's minimum in salted parts of about ``HUB`` edges, so no
    neighbourhood is gathered anywhere; rounds grow with the logarithm of the
    longest path and end when stars are left.  Every round is stored, which also
    cuts the lineage.
    """
    now = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, met = _with_least(both)
        large = (met.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                 .where("u <> v").distinct())
        down, met = _with_least(large)
        small = (met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        now = stage(small, "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
