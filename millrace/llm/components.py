"""Connected components of a graph in DataFrames, for the operators on pairs.

Rounds of large-star and small-star: every node hands its larger neighbours to the smallest node it
knows, then its smaller ones. Each round is written to the shared folder, so lineage stays short and no node or
edge ever reaches the driver; only counts do. A hot node is met by partial minima before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def _with_smallest(edges: DataFrame, own: bool) -> DataFrame:
    """(u, v) and the smallest of v and u itself for each u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def connected(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Undirected edges (u, v) to (node, root): root is the smallest node that links reach.

    Nodes without an edge to another node do not appear. Null ends are left out.
    """
    edges = edges.select(F.col("u"), F.col("v")).filter("u is not null and v is not null and u <> v")
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both, True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _with_smallest(large, True)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = written(moved.filter("u <> v").distinct(), name)
        n, sums, digest = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if (n, sums, digest) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = (n, sums, digest)
    raise RuntimeError(f"components of {name} did not settle in {max_rounds} rounds")
