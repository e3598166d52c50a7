"""Connected components of a link table, entirely as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import loose
from tidemark.llm.common import settle


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(down: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung under the least node of that neighbourhood."""
    both = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.join(loose(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(down: DataFrame) -> DataFrame:
    """The neighbours below a node, and the node, are hung under the least of them."""
    held = down.join(loose(_least_neighbour(down)), "u")
    moved = held.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(_least_neighbour(down).select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two columns of bigint); component is its least node.

    Alternating large and small stars until nothing moves. A hub's links are folded on the map side or
    split by adaptive skew handling; each round is checkpointed, so a lost executor costs one round.
    Loops, repeated links and nulls are ignored; an empty table gives an empty one.
    """
    a, b = links.columns[:2]
    down = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    down, seen = settle(down.distinct()), None
    while True:
        state = down.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        down = settle(_small_star(_large_star(down)))
    roots = down.select(F.col("v").alias("node")).distinct()
    return down.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
