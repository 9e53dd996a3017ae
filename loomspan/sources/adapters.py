"""Sensor samples derived from the driver's tables, for tests and benchmarks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.operators.windows import dealt


def by_user():
    return Window.partitionBy("user_id").orderBy("ts", "event_id")


def so_far():
    return Window.partitionBy("user_id").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)


def div(a, n: int):
    return F.floor((F.col(a) if isinstance(a, str) else a) / n).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their number in the user's order. They are dealt by user to a number of tasks that grows with the rows."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return dealt(e, e.count(), "user_id").withColumn("rn", F.row_number().over(by_user()))


def gaze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sess, ord, t (epoch ms), x, y."""
    step = 20 + F.col("k") + F.when((F.col("event_type") == "signup") & (F.col("k") < 10), 400).otherwise(0)
    e = events(spark, sf_dir).withColumns({"t": F.lit(1700000000000) + F.sum(step).over(so_far()), "blk": div("rn", 8) * 2 + (F.col("rn") % 8 == 7).cast("int")})
    x = (F.col("blk") * 389 + F.col("user_id") * 97) % 1500 - 20 + F.col("value") / 50
    y = (F.col("blk") * 211 + F.col("user_id") * 53) % 940 - 10 + F.col("k") % 11
    return e.select(F.col("user_id").alias("sess"), F.col("rn").alias("ord"), F.col("t").cast("long").alias("t"), x.cast("double").alias("x"), y.cast("double").alias("y"))


def letter(k, n: int):
    return F.chr((65 + k % n).cast("long"))


def key_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sess, ord, token, down, up (us), hold (ms)."""
    k = F.col("k")
    token = F.when(k < 40, letter(k, 26)).when(k < 48, (k % 10).cast("string"))
    for top, name in ((60, "SPACE"), (64, "BACKSPACE"), (66, ","), (78, "CONTROL"), (80, "SHIFT"), (82, "ENTER"), (84, "ARROWLEFT"), (88, "Z"), (92, "V"), (96, "X")):
        token = token.when(k < top, name)
    hold = 30 + (k * 37) % 200
    e = events(spark, sf_dir).withColumn("down", (F.sum(60 + F.round(F.col("value") * 10).cast("long")).over(so_far()) * 1000).cast("long"))
    return e.select(F.col("user_id").alias("sess"), F.col("rn").alias("ord"), token.otherwise("C").alias("token"), "down", (F.col("down") + hold * 1000).cast("long").alias("up"), hold.cast("double").alias("hold"))


def key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sess, ord, token, action, t (us)."""
    e = events(spark, sf_dir).withColumn("t", (F.sum(60 + F.round(F.col("value") * 10).cast("long")).over(so_far()) * 1000).cast("long"))
    return e.select(F.col("user_id").alias("sess"), F.col("rn").alias("ord"), letter(F.col("k"), 5).alias("token"), F.when(F.col("event_type").isin("click", "view", "signup"), "KEY_DOWN").otherwise("KEY_UP").alias("action"), "t")


def touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sess, ord, t (us from the first), pi, et, px, py, p, h, w."""
    k, m = F.col("k"), F.col("rn") % 8
    e = events(spark, sf_dir).withColumn("blk", div("rn", 8))
    step = F.when(F.col("blk") % 3 == 2, 120 + k).otherwise(8 + k % 20)
    e = e.withColumn("ms", F.sum(step).over(so_far())).withColumn("t", ((F.col("ms") - F.min("ms").over(Window.partitionBy("user_id"))) * 1000).cast("long"))
    swipe = F.col("blk") % 3 == 1
    return e.select(
        F.col("user_id").alias("sess"), F.col("rn").alias("ord"), "t", (F.col("blk") % 2).cast("int").alias("pi"),
        F.when(m == 0, 1).when(m <= 5, 2).when(m == 6, 3).otherwise(4).alias("et"),
        ((F.col("blk") * 211) % 1200 + 100 + F.when(swipe, m * (10 + k % 30)).otherwise(k % 3)).cast("double").alias("px"),
        ((F.col("blk") * 137) % 700 + 50 + F.when(swipe, m * (k % 20)).otherwise(k % 2)).cast("double").alias("py"),
        ((k % 101) / 100).alias("p"), (5 + k % 7).cast("double").alias("h"), (4 + F.col("value") / 100).alias("w"),
    )


def voice_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sess, ord (frame from 1 in the session), rms."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_custkey") % 20).alias("sess"), "o_orderkey", "o_totalprice")
    o = o.withColumn("ord", F.row_number().over(Window.partitionBy("sess").orderBy("o_orderkey")))
    return o.select("sess", "ord", F.when(div("ord", 30) % 3 == 0, F.lit(1e-6)).otherwise(F.col("o_totalprice") / 1e6).cast("float").alias("rms"))


def audio_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("sess"), F.col("embedding").alias("y"))


#: Samples a second, and samples, of the signals below.
RATE, SAMPLES = 4000, 800


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sess, y: a tone with one overtone for each customer, its pitch from the customer's numbers, in 64ths. Customers are dealt to tasks before the tones are made, as a file of few bytes is one task."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    c = dealt(rows, rows.count(), "c_custkey", share=2_000).select(F.col("c_custkey").alias("sess"), (100 + (F.col("c_custkey") * 7) % 300 + F.col("c_nationkey") / 10.0).cast("double").alias("hz"), F.col("c_nationkey").alias("k"))
    at = lambda i, n: 2 * math.pi * n * F.col("hz") * i / RATE
    wave = lambda i: F.round(64 * (0.5 * F.sin(at(i, 1)) + 0.3 * F.sin(at(i, 2) + F.col("k"))) * F.when(i >= SAMPLES // 2, F.lit(1.0)).otherwise((F.col("k") % 4 + 1) / 4.0)) / 64
    return c.select("sess", F.transform(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), wave).alias("y"))
