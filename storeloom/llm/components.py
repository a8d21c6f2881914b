"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storeloom.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star operation on edges ``(u, v)`` with u > v; the same kind of edges.

    Large-star links the neighbours of a node that are larger than it to the
    smallest node among the neighbours and itself; small-star links the
    neighbours that are smaller, and the node itself, to the smallest of them.
    The smallest neighbour is an aggregate and joined back, so the node that a
    third of all edges meet in is spread over the map side and a skewed join.
    """
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges if small else edges.unionByName(turned)
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    if not small:
        least = least.select("u", F.least("u", "m").alias("m"))
        moved = turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = edges.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return moved.filter("u <> v").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every node that a link to another node holds.

    ``links`` has longs ``a`` and ``b``; the order and repeats do not matter,
    links with a null end and loops are none. Each round is a written table. It
    ends when a round leaves the edges as they were, after about log2 of the
    longest path squared rounds at worst.
    """
    edges = written(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    # Counts and a sum of hashes of the edge set tell whether it changed.
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = edges.agg(*mark).first()
    while before[0]:
        edges = written(_star(_star(edges, small=False), small=True), name)
        after = edges.agg(*mark).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
