"""Operators along a sequence: runs, last-in-first-out pairing, strokes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list[str], label: str, name: str = "island") -> DataFrame:
    """df with a number for each run of equal labels (nulls are equal) along the order."""
    run = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_same", F.col(label).eqNullSafe(F.lag(label).over(run)) & (F.row_number().over(run) > 1))
    return df.withColumn(name, F.sum(F.when(F.col("_same"), 0).otherwise(1)).over(run)).drop("_same")


def lifo_pairs(df: DataFrame, keys: list[str], order: list[str], opens: Column, closes: Column, t: str) -> DataFrame:
    """Pairs of an opening and the closing that takes it from the top of the key's stack: keys, opened, closed.

    A row's depth is the running balance above its lowest value so far; an opening and its closing share a depth and are neighbours at it, so a pair is a row and its successor of the same depth. Closings of an empty stack and openings left on it have none.
    """
    run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(opens, 1).when(closes, -1)
    s = df.withColumn("_step", step).where("_step IS NOT NULL").withColumn("_sum", F.sum("_step").over(run))
    s = s.withColumn("_low", F.least(F.lit(0), F.min("_sum").over(run)))
    s = s.withColumn("_level", F.col("_sum") - F.col("_low") + F.when(F.col("_step") < 0, 1).otherwise(0))
    spare = (F.col("_step") < 0) & (F.col("_sum") == F.col("_low")) & (F.col("_low") < F.coalesce(F.lag("_low").over(Window.partitionBy(*keys).orderBy(*order)), F.lit(0)))
    s = s.withColumn("_spare", spare).where("NOT _spare")
    at = Window.partitionBy(*keys, "_level").orderBy(*order)
    s = s.withColumns({"_next": F.lead("_step").over(at), "closed": F.lead(t).over(at)})
    return s.where("_step = 1 AND _next = -1").select(*keys, F.col(t).alias("opened"), "closed")


def stroke_ids(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with stroke: from a pointer's DOWN (et 1) to its UP (et 3), both included; null outside. Strokes of a group are numbered by pointer, then time."""
    before = Window.partitionBy(*keys, "pi").orderBy("t", "ord").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("et").isin(1, 3), F.col("et")), ignorenulls=True).over(before)
    number = F.count_if(F.col("et") == 1).over(Window.partitionBy(*keys).orderBy("pi", "t", "ord").rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"_last": last, "_number": number}).withColumn("stroke", F.when((F.col("et") == 1) | (F.col("_last") == 1), F.col("_number") - 1)).drop("_last", "_number")
