"""Connected components of an edge table by alternating stars.

Each round lets every node hand its larger neighbours to its smallest one (large star) and then
all its smaller neighbours (small star). Edges only ever get fewer or point lower, a component
becomes one star around its smallest node, and the number of rounds grows with the logarithm
of the longest chain. Both minima are written before they are joined, so that a node with very
many neighbours is a hot key of a plain shuffle join, which Spark splits; nothing is gathered
per node. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom import store


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Every edge (u, v) moved to the smallest neighbour of u: (v, smallest), and (u, smallest)."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("root"))
    return store.materialise(least, name)


def _ordered(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return pairs.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for all nodes but the roots.

    ``edges`` has two columns u and v of one orderable type. Loops and repeats do no harm.
    """
    now = store.materialise(_ordered(edges), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _star(both, "least-all")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
        large = store.materialise(_ordered(large), "large-star")
        least = _star(large, "least-below")
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
        own = least.select("u", F.col("root").alias("v"))
        now = store.materialise(_ordered(moved.unionByName(own)), "small-star")
        before, mark = mark, now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
