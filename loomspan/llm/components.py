"""Connected components of a graph in a DataFrame, by alternating star contraction.

No node's neighbours meet in one task: a round takes the least neighbour of every node (a sum that combines on the map
side) and joins it back, and skewed join partitions can be split. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import cut


def stars(batches):
    """Of the edges (u, v) of one task: (node, root) of each node, the root being the least that is reached."""
    root: dict[int, int] = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for u, v in zip(*(batch.column(c).to_pylist() for c in ("u", "v")), strict=True):
            low, high = sorted((top(u), top(v)))
            root[high] = low
    if root:
        yield pa.RecordBatch.from_arrays([pa.array(list(root), pa.int64()), pa.array([top(x) for x in root], pa.int64())], ["node", "root"])


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, alone: int = 0) -> DataFrame:
    """(node, root) for every node of an edge: root is the least node of its component. Loops, repeated and reversed edges are fine; nulls are dropped. alone: a graph of so many edges at most is solved in one task, without rounds."""
    live = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    if alone > 0 and live.count() <= alone:
        return live.coalesce(1).mapInArrow(stars, "node long, root long")
    seen = None
    for _ in range(most_rounds):
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: neighbours above a node move to the node's least neighbour
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: neighbours below a node, and the node, move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u > v").distinct()
        live = cut(small)
        now = live.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == now:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return live.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(live.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
