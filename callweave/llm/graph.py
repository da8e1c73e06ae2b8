"""Connected components of an undirected graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the larger to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns u, v): the least node it reaches.

    Large-star and small-star steps alternate until the links no longer change, each
    round written to the shared folder. No node's links are gathered in one value: the
    least neighbour is a pre-aggregated minimum and joined back, where adaptive execution
    splits a node with very many links. No links give no rows."""
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(ordered.distinct(), "components")
    before = _state(edges)
    for step in range(rounds):
        if before[0] == 0:
            break
        large = _large_star(edges).where("u <> v").distinct()
        edges = stored(_small_star(large).where("u <> v").distinct(), f"components{step}")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
