"""Session-anchored hopping windows.

Times are integers (ms, us or frames). Window k of a session starts at its anchor plus k strides. A sample is dealt
to its windows by arithmetic on its distance from the anchor, so nothing is compared with all windows. The anchors are
an aggregate of the sessions, joined back: a join, unlike a window over the session, is split where a session is long, and
broadcast where the sessions are few. What follows is dealt by session and window to a number of tasks that grows with the
rows, so a session of any length is spread over tasks and a task's share stays the same however large the input is.

Policies: CLIPPED ends windows at the session's last time and leaves out starts from there on; FULL keeps their
length; NONEMPTY also starts one at the last time, and numbers only windows that hold a sample; PADDED is FULL with
the session's end given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLIPPED, FULL, NONEMPTY, PADDED = "clipped", "full", "nonempty", "padded"


def check(size: int, stride: int) -> None:
    if size <= 0 or stride <= 0:
        raise ValueError("window size and stride must be positive")


#: Rows that a task is meant to hold. Rows of many samples grow to hundreds of columns, which their bytes in a shuffle don't show.
SHARE = 100_000


def dealt(df: DataFrame, rows: int, *keys: str, share: int = SHARE) -> DataFrame:
    """df dealt by its keys to tasks of about `share` of its rows; small ones to as many tasks as run at once."""
    return df.repartition(max(-(-rows // share), df.sparkSession.sparkContext.defaultParallelism), *keys)


def last_window(policy: str, t0: Column, t_max: Column, stride: int) -> Column:
    """Number (from 0) of a session's last window; below 0 if it has none."""
    span = t_max - t0
    return F.floor(span / F.lit(stride)) if policy == NONEMPTY else F.ceil(span / F.lit(stride)) - 1


def spine(bounds: DataFrame, policy: str, size: int, stride: int) -> DataFrame:
    """(sess, win, w_start, w_end) of every candidate window from (sess, t0, t_max). NONEMPTY numbers candidates; assign() renumbers."""
    check(size, stride)
    last = last_window(policy, F.col("t0"), F.col("t_max"), stride).cast("long")
    ks = bounds.withColumn("_last", last).where("_last >= 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))).alias("_k"))
    start = F.col("t0") + F.col("_k") * stride
    end = F.least(start + size, F.col("t_max")) if policy == CLIPPED else start + size
    return ks.select("sess", (F.col("_k") + 1).cast("int").alias("win"), start.alias("w_start"), end.alias("w_end"))


def bounds(samples: DataFrame, t: str, end: str | None = None) -> DataFrame:
    return samples.groupBy("sess").agg(F.min(t).alias("t0"), F.max(end or t).alias("t_max"))


def assign(samples: DataFrame, t: str, policy: str, size: int, stride: int, end: str | None = None) -> DataFrame:
    """A row for each sample and window that holds it: the sample's columns with win, w_start, w_end.

    Samples without a time are in no window. t is when a sample counts; `end` (else t) is what a session's last time is taken from.
    """
    check(size, stride)
    timed = samples.where(F.col(t).isNotNull())
    wide = timed.join(bounds(timed, t, end).withColumnRenamed("sess", "_sess"), F.col("sess").eqNullSafe(F.col("_sess"))).drop("_sess")
    rel = F.col(t) - F.col("t0")
    low = F.greatest(F.lit(0), F.floor((rel - size) / F.lit(stride)) + 1)
    high = F.least(F.floor(rel / F.lit(stride)), last_window(policy, F.col("t0"), F.col("t_max"), stride))
    held = wide.withColumns({"_lo": low.cast("long"), "_hi": high.cast("long")}).where("_lo <= _hi").select("*", F.explode(F.sequence("_lo", "_hi")).alias("_k"))
    start = F.col("t0") + F.col("_k") * stride
    stop = F.least(start + size, F.col("t_max")) if policy == CLIPPED else start + size
    out = held.withColumns({"w_start": start, "w_end": stop}).where(F.col(t) < F.col("w_end"))
    if policy == NONEMPTY:  # windows with a sample are numbered, of which a session has few
        held = out.select(F.col("sess").alias("_sess"), F.col("_k").alias("_j")).distinct()
        held = held.withColumn("win", F.row_number().over(Window.partitionBy("_sess").orderBy("_j")))
        out = out.join(held, F.col("sess").eqNullSafe(F.col("_sess")) & (F.col("_k") == F.col("_j"))).drop("_sess", "_j")
    else:
        out = out.withColumn("win", (F.col("_k") + 1).cast("int"))
    return dealt(out.drop("t0", "t_max", "_lo", "_hi", "_k"), -(-size // stride) * samples.count(), "sess", "win")
