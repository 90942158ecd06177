"""Connected components of an edge table by alternating star contractions.

Each round turns the edges into stars around smaller nodes (first towards larger
neighbours, then towards smaller ones).  The number of edges never grows and the
number of rounds is logarithmic in the longest path, so neither links nor components
ever gather in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.runtime import materialize, release


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component) for every node that has an edge to another node.

    ``component`` is the smallest node reachable.  Null ends and loops are ignored;
    repeated edges and either direction count as one edge.
    """
    u, v = F.greatest(src, dst), F.least(src, dst)
    now = materialize(edges.where(f"`{src}` <> `{dst}`").select(u.alias("u"), v.alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        # Large star: every node hands its larger neighbours to its smallest one.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every node hands its smaller neighbours, and itself, to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        new = materialize(small, "edges")
        release(now)
        now, before, state = new, state, _state(new)
        if state == before:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
