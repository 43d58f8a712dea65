"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.session import cut_lineage


ROWS_PER_TASK = 100_000


def tasks_for(rows: int) -> int:
    """Small intermediate tables keep few partitions, whatever a shuffle is set to."""
    return max(1, -(-rows // ROWS_PER_TASK))


def _stars(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One star step: neighbours of a node move to the smallest of its neighbourhood.

    The minimum is a pre-aggregated fold and is joined back, so a node with very many
    neighbours is split by adaptive execution and never gathered.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(low, "a").coalesce(tasks)
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct().coalesce(tasks)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    Alternating large and small stars halve distances; each round is a checkpoint, so a
    lost executor costs one round.
    """
    current = cut_lineage(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )
    tasks = tasks_for(current.count())
    current = current.coalesce(tasks)
    mark = None
    while True:
        current = cut_lineage(_stars(_stars(current, True, tasks), False, tasks))
        row = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if mark == tuple(row):
            break
        mark = tuple(row)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
