"""Connected components by alternating star operations, every step a join or an aggregate over a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import durable

MAX_ROUNDS = 40


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the component's smallest node.

    The rounds end when the star table stays as it is, which takes about log(longest path) of them. The smallest
    neighbour is found by an aggregate that combines before it shuffles, and AQE splits hubs in the joins.
    """
    state = durable(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        state = durable(_small_star(_large_star(state)), "stars")
        seen = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("the components did not settle")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
