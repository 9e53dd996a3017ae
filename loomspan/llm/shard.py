"""Weighted rendezvous sharding with DataFrame functions only.

A record's score in shard s is -weight_s / ln(u), with u from 60 bits of md5(key:s); the highest score wins. Scores
of the other shards don't change when one is added, so one more shard takes rows only into itself, and the expected
share of a shard is its weight's share. md5 makes the placement the same in every engine and release.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import fresh

#: Parts of a shard that are numbered apart; their counts (shards x PARTS rows) are what is broadcast.
PARTS = 256


def unit(key: Column, shard: Column) -> Column:
    """A number in (0, 1) from key and shard."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), shard.cast("string"))), 1, 15), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**60))


def scores(key: Column, weights: list[float]) -> Column:
    """Array of the key's scores, one for each shard."""
    w = F.array(*(F.lit(float(x)) for x in weights))
    return F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda s: -F.element_at(w, s + 1) / F.ln(unit(key, s)))


def assign(df: DataFrame, key: str, weights: list[float], grown_weight: float | None = None) -> DataFrame:
    """df with shard and, with grown_weight, grown_shard: the shard after one more of that weight has been added.

    Equal keys share a shard. A null key counts as the empty text. A tie goes to the lower shard. Columns of df named shard or grown_shard are replaced.
    """
    if not weights or min(weights) <= 0 or (grown_weight is not None and grown_weight <= 0):
        raise ValueError("weights must be positive")
    k, n = F.coalesce(F.col(key).cast("string"), F.lit("")), len(weights)
    wide = df.drop("shard", "grown_shard")
    held = fresh(wide, "_scores")
    wide = wide.withColumn(held, scores(k, [*weights, *([grown_weight] if grown_weight else [])]))
    before = F.slice(held, 1, n)
    out = wide.withColumn("shard", (F.array_position(before, F.array_max(before)) - 1).cast("int"))
    if grown_weight:
        out = out.withColumn("grown_shard", F.when(F.element_at(held, n + 1) > F.array_max(before), F.lit(n)).otherwise(F.col("shard")).cast("int"))
    return out.drop(held)


def number(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with slot: rows of a shard numbered from 0 without gaps.

    A shard's rows are numbered in PARTS parts by the first two hexadecimal digits of the key's md5, each shifted by the rows of the parts before it, so no task needs a whole shard. Rows that tie on key and order are interchangeable.
    """
    hexes = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 2)
    df = df.drop("slot")
    part, place, shift = (fresh(df, x) for x in ("_part", "_rank", "_shift"))
    wide = df.withColumn(part, F.conv(hexes, 16, 10).cast("int"))
    counts = wide.groupBy("shard", part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("shard", part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(shift))
    rank = F.row_number().over(Window.partitionBy("shard", part).orderBy(key, *order))
    out = wide.withColumn(place, rank).join(F.broadcast(shifts), ["shard", part]).withColumn("slot", (F.col(shift) + F.col(place) - 1).cast("long"))
    return out.drop(part, place, shift)


def shard_documents(docs: DataFrame, weights: list[float], grown_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of docs (doc_id, text). Null texts have no bytes; repeated rows share a shard and get slots of their own."""
    slim = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = number(assign(slim, "doc_id", weights, grown_weight), "doc_id", ["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")



def oracle(n: int) -> str:
    """SQL of shard_documents over `documents` with n equal weights and one more; crc32 goes byte by byte through its table of remainders."""
    return f"""WITH RECURSIVE bits AS (SELECT i AS k, i AS c, 0 AS n FROM range(256) t(i) UNION ALL SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
tab AS (SELECT list(c ORDER BY k) AS t FROM bits WHERE n = 8),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM documents, tab),
s AS (SELECT *, list_transform(range({n + 1}), lambda s: -1.0 / ln((('0x' || substr(md5(id || ':' || s), 1, 15))::BIGINT::DOUBLE + 0.5) / 1152921504606846976.0)) AS w FROM d),
a AS (SELECT *, (list_position(w[1:{n}], list_max(w[1:{n}])) - 1)::INT AS shard, (list_position(w, list_max(w)) - 1)::INT AS grown_shard FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY substr(md5(id), 1, 2), doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown_shard FROM a"""
