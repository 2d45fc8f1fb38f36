"""Connected components of a link table, by alternating star contractions on Spark.

Every round replaces links by links to the least known neighbour, first upwards, then downwards, until all
components are stars. A round is four joins or aggregations of two-column rows; each is written to the
shared folder, which cuts the lineage. Minima combine before their shuffle, and joins on a much-linked node
are ordinary equi-joins that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochloom.shared import materialise


def _upward(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the least of its neighbours and itself."""
    both = edges.union(edges.select("m", "u"))
    least = both.groupBy("u").agg(F.min("m").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.where("m > u").join(least, "u").select(F.col("m").alias("u"), F.col("least").alias("m"))


def _downward(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the least of them."""
    least = edges.groupBy("u").agg(F.min("m").alias("least"))
    moved = edges.join(least, "u").where("m != least").select(F.col("m").alias("u"), F.col("least").alias("m"))
    return moved.union(least).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "m").cast("decimal(38,0)"))).first())


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """Rows (node, component) for all linked nodes; the component is its smallest node. NULLs link nothing."""
    a, b = F.col(one), F.col(other)
    edges = materialise(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("m")).distinct(), "links"
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        edges = materialise(_downward(_upward(edges)), "links")
    roots = edges.select("m").distinct().select("m", F.col("m").alias("component"))
    return edges.select("u", "m").union(roots).toDF("node", "component")
