"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Alternates two joins of narrow rows: every node points its larger neighbours, then its smaller
    ones, to the smallest node it knows. The depth halves each time, so the number of rounds grows
    with the logarithm of the longest path. Each round is written to the shared folder. A node with
    many neighbours is one key of a partial minimum and one side of a join that adaptive execution
    may split, never one group in memory.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.where("u <> v").distinct(), "links")
    while True:
        large = _large_star(edges)
        small = written(_small_star(large), "star")
        edges = small
        if _finished(small):
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _finished(edges: DataFrame) -> bool:
    """Whether all components are stars: no root is below another node, and every node has one root."""
    roots = edges.select(F.col("v").alias("u")).distinct()
    if edges.join(roots, "u", "left_semi").limit(1).count():
        return False
    # Where no root is below another, a node with two still holds together their components.
    ends = edges.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    return ends.where("least < most").limit(1).count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("node"), F.col("v").alias("near")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("u").alias("near"))
    )
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    pointed = both.where("near > node").join(least, "node")
    return pointed.select(F.col("near").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    pointed = edges.join(least, "u")
    near = pointed.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return near.unionByName(own).distinct()
