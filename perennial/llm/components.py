"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.llm.shared import drop_settled, settle


def _towards_min(edges: DataFrame) -> DataFrame:
    """Edges as (node, low) with low < node."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low"))
        .distinct()
    )


def _star(neighbours: DataFrame, larger_only: bool) -> DataFrame:
    """Hang the neighbours of every node below the least of them.

    ``neighbours`` holds (u, v); the least is at most u itself. A node with very many
    neighbours is summed before the shuffle, and the join back is one that adaptive
    execution may split.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("low"))
    joined = neighbours.join(least, "u")
    if larger_only:
        return joined.where("v > u").select(F.col("v").alias("node"), "low")
    return joined.select(F.col("v").alias("node"), "low").unionByName(
        least.select(F.col("u").alias("node"), "low")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the least node names it.

    Alternates large and small stars until nothing moves, so a chain of n nodes takes
    about log n rounds. Each round is a table in the shared folder. Empty edges give an
    empty table.
    """
    now = settle(_towards_min(edges), "edges")
    last = None
    while True:
        figures = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "low"))).first()
        if figures == last or not figures[0]:
            break
        last = figures
        both = now.select(F.col("node").alias("u"), F.col("low").alias("v")).unionByName(
            now.select(F.col("low").alias("u"), F.col("node").alias("v"))
        )
        large = _star(both, larger_only=True).where("node <> low").distinct()
        small = _star(large.select(F.col("node").alias("u"), F.col("low").alias("v")), larger_only=False)
        after = settle(small.where("node <> low").distinct(), "edges")
        drop_settled(now)
        now = after
    roots = now.select(F.col("low").alias("node")).distinct()
    return now.select("node", F.col("low").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
