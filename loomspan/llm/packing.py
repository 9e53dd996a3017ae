"""Conflict-constrained best-fit packing.

Documents are cut in pieces of at most `capacity` bytes. Pieces are dealt to groups by a hash of the document's id; a
group is packed in one task by best fit in order of falling size. Open bins stand in the order of their residuals and
carry a bitmap of their sources and one of their duplicate clusters; the search starts at the first bin that is large
enough and goes on to its successors until one is compatible, so it ends at the tightest compatible bin.
Groups hold about GROUP_BINS capacities, so the loss at their ends is small. A group that ids which come very often make
larger is cut at GROUP_ROWS rows, so a task's memory is bounded.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY = 8192
GROUP_BINS = 256
GROUP_ROWS = 50_000


def best_fit(pieces: list[tuple[int, int | None, int | None]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of pieces (size, source, cluster) in the order given. A bin holds no two pieces of a source or of a cluster; None never conflicts. A size of more than capacity is an error."""
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    sources, clusters = [], []
    bit: dict = {}
    out = []
    for size, source, cluster in pieces:
        if size > capacity:
            raise ValueError("a piece exceeds the capacity")
        s = 0 if source is None else 1 << bit.setdefault((0, source), len(bit))
        c = 0 if cluster is None else 1 << bit.setdefault((1, cluster), len(bit))
        i = bisect.bisect_left(open_bins, (size, -1))
        while i < len(open_bins) and (sources[open_bins[i][1]] & s or clusters[open_bins[i][1]] & c):
            i += 1
        if i < len(open_bins):
            residual, b = open_bins.pop(i)
            sources[b] |= s
            clusters[b] |= c
        else:
            residual, b = capacity, len(sources)
            sources.append(s)
            clusters.append(c)
        out.append((b, capacity - residual))
        bisect.insort(open_bins, (residual - size, b))
    return out


def cluster_of(text):
    """Duplicate cluster of a text: a hash of its lower-cased words; null without words."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare != "", F.xxhash64(F.regexp_replace(F.lower(bare), r"[\x20\x09-\x0D]+", " ")))


def pack(docs: DataFrame, capacity: int = CAPACITY, group_bins: int = GROUP_BINS, clusters: DataFrame | None = None) -> DataFrame:
    """doc_id, piece, size, bin (text: group and number), at (offset in the bin) of every piece of docs (doc_id, text, source).

    clusters (doc_id, cluster): duplicate clusters; by default texts with equal lower-cased words are one; of a document named twice the least cluster counts. Null and empty texts are one piece of size 0. A null source or cluster conflicts with none; texts without words have no cluster. Pieces of one document conflict with each other, like documents of a source. Repeated rows are documents of their own. No rows: no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("n"), *([] if clusters is not None else [cluster_of(F.col("text")).alias("cluster")]))
    if clusters is not None:
        one = clusters.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.min("cluster").alias("cluster"))
        slim = slim.join(one, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").drop("_doc")
    total, rows = slim.agg(F.sum("n"), F.count("*")).first()
    n_groups = max(1, -(-(total or 0) // (capacity * group_bins)), -(-rows // (32 * group_bins)))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(capacity).cast("long"))
    pieces = slim.select("doc_id", "source", "cluster", "n", F.posexplode(starts).alias("piece", "a"))
    pieces = pieces.select("doc_id", "piece", F.least(F.col("n") - F.col("a"), F.lit(capacity)).alias("size"), "source", "cluster", F.pmod(F.xxhash64("doc_id", "piece", "n", "cluster"), F.lit(n_groups)).alias("grp"))
    turn = F.row_number().over(Window.partitionBy("grp").orderBy("doc_id", "piece", "size"))
    pieces = pieces.withColumn("part", F.floor((turn - 1) / F.lit(GROUP_ROWS)))

    def packed(key, table):
        rows = sorted(table.select(["size", "doc_id", "piece", "source", "cluster"]).to_pylist(), key=lambda r: (-r["size"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["cluster"] or 0))
        found = best_fit([(r["size"], r["source"], r["cluster"]) for r in rows], capacity)
        g = f"{key[0].as_py()}-{part}" if (part := key[1].as_py()) else key[0].as_py()
        return pa.table({
            "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "piece": pa.array([r["piece"] for r in rows], pa.int32()), "size": pa.array([r["size"] for r in rows], pa.int64()),
            "bin": pa.array([f"{g}-{b}" for b, _ in found], pa.string()), "at": pa.array([a for _, a in found], pa.int64()),
        })

    return pieces.groupBy("grp", "part").applyInArrow(packed, "doc_id long, piece int, size long, bin string, at long")


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: bins, bytes, share of the bins' room that is filled, and the fewest bins that so many bytes need."""
    out = packed.agg(F.count_distinct("bin").alias("bins"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return out.select("bins", "bytes", F.try_divide("bytes", F.col("bins") * capacity).alias("filled"), F.ceil(F.col("bytes") / capacity).alias("fewest"))
