"""Connected components of link tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MOST_TURNS = 60


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One turn. Each node links its larger (or its smaller) neighbours, and in the small turn
    itself, to the least node it knows. Joins carry one edge per row, so a node with very many
    neighbours is split like any other skewed key."""
    if small:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    moved = both.join(least, "a")
    if small:
        out = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    else:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every node of ``edges`` (long columns ``a`` and ``b``): the least node it
    reaches. Nodes without an edge are not listed; an empty table gives an empty one."""
    edges = staged(edges.filter("a != b").distinct(), "edges")
    seen = None
    for _ in range(MOST_TURNS):
        edges = staged(_stars(_stars(edges, small=False), small=True), "edges")
        # Equal counts and sums of all edges twice in a row: nothing moved.
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_TURNS} turns")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )
