"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _stars(links: DataFrame) -> DataFrame:
    """Every neighbour v of u beside the smallest node m among u and its neighbours.

    The smallest nodes are written before the join: both sides are then plain shuffles, and a
    node with very many links is split by the skew join.
    """
    least = materialize(links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("least")), "star-least")
    return links.join(least, F.col("u") == F.col("c")).select("u", "v", F.least("u", "least").alias("m"))


def connected(edges: DataFrame) -> DataFrame:
    """(u, v) links to (u, v) with v the smallest node that u can reach; only nodes with a smaller one are listed."""
    own = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = materialize(own, "components")
    before = _state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "components-large")
        small = _stars(large)
        down = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        current = materialize(down.where("u <> v").distinct(), "components")
        after = _state(current)
        if after == before:
            break
        before = after
    return current
