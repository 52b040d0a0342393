"""Connected components of an edge table by alternating large and small stars.

Every round is a few joins and grouped minima over the edges; nothing is gathered on the driver but a
count and a checksum. A node with very many neighbours is only ever a group of a minimum (combined
before the shuffle) and the one-row side of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Points the neighbours of each node at its least neighbour; edges: a > b."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return sides.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), "m"), F.struct(F.col("b").alias("x"), "m"))).alias("e"))
    return moved.select(F.col("e.x").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b of any sortable type. Returns node, component (its least node) for every node with an edge to another."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now, mark = save(now, "edges"), None
    while True:
        seen = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = save(_stars(_stars(now, True), False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
