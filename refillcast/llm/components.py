"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import staged
from refillcast.operators.joins import join_hot


def _least_neighbour(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(node).agg(F.min(other).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least one of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both, "u", "v").select("u", F.least("u", "least").alias("least"))
    return (
        join_hot(both.where("v > u"), least, "u", "inner")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them (edges point down: v < u)."""
    least = _least_neighbour(edges, "u", "v")
    moved = join_hot(edges, least, "u", "inner").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v")
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """Columns node, root (least node of the component) for every node that has an edge.

    ``edges`` has two comparable columns u and v. Rounds of large-star and small-star; each round
    is written to the shared folder, so lineage stays short. Loops and repeated edges do no harm;
    no edges give no rows.
    """
    pairs = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, before = staged(pairs, f"{name}-edges"), None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        current = staged(_small_star(_large_star(current)), f"{name}-edges")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
