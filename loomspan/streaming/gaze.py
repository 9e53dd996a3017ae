"""Windows over a stream of gaze samples.

Samples that arrive as a stream are kept by session until the watermark has passed a window's end; each finished window
is then given out once, with the same session-anchored clock as in batch. Per-window indicators of a micro-batch come
from the batch builders.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "sess long, win int, w_start long, w_end long, ord long, t long, x double, y double"
STATE = "anchor long, next long, ord long, t string"


def finished_windows(samples: DataFrame, size_ms: int, stride_ms: int, lateness: str = "10 seconds", idle_ms: int = 60_000) -> DataFrame:
    """Streaming samples (sess, ts timestamp, x, y) to the samples of finished windows (full length; the anchor is the first sample seen).

    A window is finished once a sample at least `lateness`' watermark after its end is in. A session idle for idle_ms of event time gives out what it holds and is forgotten. Samples older than the watermark are dropped by Spark.
    """
    if size_ms <= 0 or stride_ms <= 0:
        raise ValueError("window size and stride must be positive")

    def step(key, frames, state):
        import json

        if state.hasTimedOut:
            anchor, nxt, order, held = state.get
            rows = json.loads(held)
            state.remove()
            yield out(key[0], anchor, nxt, rows, max((r[1] for r in rows), default=anchor) + 1, closing=True)[0]
            return
        anchor, nxt, order, held = state.get if state.exists else (None, 0, 0, "[]")
        rows = json.loads(held)
        for f in frames:
            for ts, x, y in zip(f["ts"], f["x"], f["y"], strict=True):
                t = int(pd.Timestamp(ts).value // 1_000_000)
                rows.append([order, t, None if pd.isna(x) else float(x), None if pd.isna(y) else float(y)])
                order += 1
        rows.sort(key=lambda r: (r[1], r[0]))
        anchor = rows[0][1] if anchor is None else anchor
        done, nxt = out(key[0], anchor, nxt, rows, state.getCurrentWatermarkMs(), closing=False)
        rows = [r for r in rows if r[1] >= anchor + nxt * stride_ms]
        state.update((anchor, nxt, order, json.dumps(rows)))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, (rows[-1][1] if rows else anchor) + idle_ms))
        yield done

    def out(sess, anchor, k, rows, until, closing):
        got = []
        while (end := anchor + k * stride_ms + size_ms) <= until or (closing and anchor + k * stride_ms < until):
            start = anchor + k * stride_ms
            got += [(sess, k + 1, start, end, *r) for r in rows if start <= r[1] < end]
            k += 1
        names = ["sess", "win", "w_start", "w_end", "ord", "t", "x", "y"]
        return pd.DataFrame(got, columns=names).astype({"sess": "int64", "win": "int32", "w_start": "int64", "w_end": "int64", "ord": "int64", "t": "int64", "x": "float64", "y": "float64"}), k

    keyed = samples.select("sess", F.col("ts"), "x", "y").withWatermark("ts", lateness).groupBy("sess")
    return keyed.applyInPandasWithState(step, OUT, STATE, "append", "EventTimeTimeout")


def write_indicators(windowed: DataFrame, build: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a query that gives every micro-batch's finished windows to build (samples in windows to indicators) and its rows to sink."""

    def one(batch: DataFrame, number: int) -> None:
        sink(build(batch.withColumn("on", F.lit(True))), number)

    return windowed.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).start()
