"""Connected components of a graph given as edges, by alternating large and small stars.

Each round hangs the neighbours of a node on the smallest of them, first the
larger neighbours, then the smaller ones, until every component is a star.
Nothing but counts comes to the driver. The hub of a large component is a hot key of a join,
which adaptive execution splits. Minima are taken with partial
aggregation, and each round is cut off by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Far above the logarithm of any graph's size; reaching it is an error, not an answer.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """From edges a > b: every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """From edges a > b: a node and its smaller neighbours to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum((F.xxhash64("a", "b") % 1000003)).alias("s")).first()
    return row["n"], row["x"], row["s"]


def stars(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for each node that has a link to another: root is the least node of its component.

    Links may repeat, point either way or at themselves (or to null, which counts as themselves).
    A node without links to others is not in the result.
    """
    edges = cut(links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where("a > b").distinct())
    mark = _mark(edges)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        edges = cut(_small_star(_large_star(edges)))
        was, mark = mark, _mark(edges)
        if was == mark:
            break
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
