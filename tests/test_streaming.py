"""Windows of a stream are those of the batch."""

from pyspark.sql import functions as F

from loomspan.operators import windows as W
from loomspan.streaming import gaze


def test_stream_equals_batch(spark, tmp_path):
    rows = [(s, 1700000000000 + 40 * i + s, float(i % 50), float(s)) for s in (1, 2) for i in range(120)]
    df = spark.createDataFrame(rows, "sess long, t long, x double, y double").withColumn("ts", F.timestamp_millis("t"))
    for k in range(4):
        df.where((F.col("t") - 1700000000000) / 1300 >= k).where((F.col("t") - 1700000000000) / 1300 < k + 1).select("sess", "ts", "x", "y").coalesce(1).write.parquet(str(tmp_path / "in" / f"p{k}"))
    spark.createDataFrame([(9, 1800000000000)], "sess long, t long").select("sess", F.timestamp_millis("t").alias("ts"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).coalesce(1).write.parquet(str(tmp_path / "in" / "p9"))
    stream = spark.readStream.schema("sess long, ts timestamp, x double, y double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    got = []
    q = gaze.write_indicators(gaze.finished_windows(stream, 1000, 500, "1 second"), lambda b: b, lambda b, n: got.extend(b.select("sess", "win", "t", "x").collect()), str(tmp_path / "chk"))
    q.processAllAvailable()
    q.stop()
    want = W.assign(df.withColumn("ord", F.col("t")), "t", W.NONEMPTY, 1000, 500).select("sess", "win", "t", "x").collect()
    assert sorted(tuple(r) for r in got if r.sess != 9) == sorted(tuple(r) for r in want)
