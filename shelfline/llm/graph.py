"""Connected components of an edge table, by alternating large-star and small-star steps in DataFrame form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. ``edges`` has a > b. A node's smallest neighbour takes the node's larger (or smaller) neighbours.

    Minima are combined before the shuffle; edges of a hub are then joined to its one minimum.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; a component is named by its smallest node.

    Steps repeat until a pair of them changes nothing, which takes a logarithmic number of rounds in practice. Each
    round is a written table, so lineage stays short and a lost executor costs one round.
    """
    found = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        sizes = found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sizes == state:
            return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = sizes
        found = materialize(_star(_star(found, True), False), "edges")
