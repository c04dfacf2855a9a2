"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_hot, stored


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    return join_hot(both, least, "u", 2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = join_hot(edges, least, "u", total).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node of an edge table (u, v) of longs; root is the smallest node reachable.

    Nulls in u or v and loops are ignored; an empty table gives an empty result. The edges of a round are stored in the
    shared folder, so that neither lineage nor any one task grows with the number of rounds; a hub's edges stay where they are.
    """
    clean = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u").isNotNull() & F.col("v").isNotNull()).alias("ok"))
    now = stored(clean.filter("ok and u > v").select("u", "v").distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        if not state[0]:
            break
        large = stored(_large_star(now, state[0]), "edges")
        after = stored(_small_star(large, state[0]), "edges")
        discard(now, large)
        was, state, now = state, _state(after), after
        if was == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
