"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 60


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(node, root))"), F.lit(0))).first()
    return row[0], row[1]


def _smaller_neighbours(pairs: DataFrame) -> DataFrame:
    """Pairs whose smaller side comes second; no loops, no repeats."""
    return pairs.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()


def components(links: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` but the roots; a root is the smallest node it reaches.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to
    the larger ones, then to the smaller ones. Both are a minimum per node, combined before
    the shuffle, and one join, so a node with very many links is no task of its own. The
    table is written by ``keep`` after each round. Nodes may be of any type that has an order.
    """
    edges = keep(_smaller_neighbours(links))
    mark = _mark(edges)
    for _ in range(ROUNDS):
        if not mark[0]:
            return edges
        both = edges.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(
            edges.select(F.col("root").alias("x"), F.col("node").alias("y"))
        )
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("node"), F.col("m").alias("root"))
        large = large.filter("node <> root").distinct()
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(least, "node").select(F.col("root").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
        edges = keep(_smaller_neighbours(small))
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges
    raise RuntimeError(f"no stable components after {ROUNDS} rounds")
