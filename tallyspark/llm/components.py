"""Connected components of a graph given by its edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _signature(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    A large star links the larger neighbours of a node to the smallest one, a small star the
    smaller ones; both keep components as they are, and their fixed point is one star per component.
    Minima are aggregated before they are joined back, so no neighbour list is gathered. Every round
    is stored in the shared folder and replaces the one before. Loops and repeated edges are ignored.
    """
    pairs = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = _signature(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v").where(F.col("u") != F.col("v")).distinct()
        )
        pairs = materialise(small, instead_of=pairs)
        now = _signature(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
