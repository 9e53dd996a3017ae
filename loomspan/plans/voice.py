"""Voice indicators (31): frames of windows to one row for each session and window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import spectral
from loomspan.functions.stats import null4, ratio, scalar4, slope, stats4
from loomspan.operators.sequence import islands
from loomspan.operators.windows import PADDED, assign, bounds, dealt, spine

from .config import PIConfig

G = ["sess", "win"]
HOP, PAUSE, FLOOR, SHARE, SILENT = 0.01, 0.20, 1e-6, 0.15, 1e-6


def in_order():
    return Window.partitionBy(*G).orderBy("i")


def in_window():
    return Window.partitionBy(*G)


def windows(frames: DataFrame, cfg: PIConfig) -> DataFrame:
    """(sess, win, w_start, i, rms, f0) of frames (sess, ord, rms and, if there, f0) at 100 a second: padded windows, each with all its frames; beyond the end they are silent."""
    size, stride = round(cfg.window_s / HOP), round(cfg.stride_s / HOP)
    f = frames if "f0" in frames.columns else frames.withColumn("f0", F.lit(None).cast("double"))
    end = f.withColumn("_end", F.col("ord") + 1)
    held = assign(end, "ord", PADDED, size, stride, end="_end").select(*G, (F.col("ord") - F.col("w_start")).alias("i"), "rms", "f0")
    every = spine(bounds(end, "ord", "_end"), PADDED, size, stride).select(*G, "w_start", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long"))).alias("i"))
    full = every.join(held, [*G, "i"], "left").withColumn("rms", F.coalesce("rms", F.lit(SILENT).cast("float")))
    return dealt(full, -(-size // stride) * frames.count(), *G)


def frames(signals: DataFrame, rate: int) -> DataFrame:
    """(sess, win, i, rms, f0) of whole signals (sess, y): frames with loudness and pitch, in one window."""
    f = signals.select("sess", F.posexplode(spectral.track("y", F.lit(rate))).alias("i", "f"))
    return f.select("sess", F.lit(1).alias("win"), F.col("i").cast("long").alias("i"), "f.rms", "f.f0")


def speech(windowed: DataFrame) -> DataFrame:
    """Frames with speech: at or above the floor and 0.15 of the 75th percentile, in single precision, so that digital silence meets the floor."""
    p75 = F.expr("percentile(rms, 0.75)").over(in_window())
    return windowed.withColumn("speech", F.col("rms") >= F.greatest(F.lit(FLOOR), p75 * SHARE).cast("float"))


def pauses(sp: DataFrame) -> DataFrame:
    """sp with pause: whether the frame is in a run without speech of 0.2 s or more."""
    runs = islands(sp, G, ["i"], "speech")
    n = F.count("*").over(Window.partitionBy(*G, "island"))
    return runs.withColumn("n_run", n).withColumn("pause", ~F.col("speech") & (F.col("n_run") * HOP >= PAUSE))


def pause_stats(pa: DataFrame, cfg: PIConfig) -> DataFrame:
    """Times of speech, pauses and utterances (from the first to the last speech frame between two pauses)."""
    T = cfg.window_s
    runs = pa.where("pause").groupBy(*G, "island").agg((F.count("*") * HOP).alias("d")).groupBy(*G).agg(*stats4("pause_duration", "d", 0), F.sum("d").alias("sp"), F.count("*").alias("np"))
    parts = islands(pa.drop("island"), G, ["i"], "pause").where("NOT pause").groupBy(*G, "island").agg(F.min(F.when(F.col("speech"), F.col("i"))).alias("a"), F.max(F.when(F.col("speech"), F.col("i"))).alias("b")).where("a IS NOT NULL")
    utt = parts.withColumn("d", (F.col("b") + 1) * HOP - F.col("a") * HOP).groupBy(*G).agg(*stats4("utterance_duration", "d", 0), F.sum("d").alias("su"), F.count("*").alias("nu"))
    base = pa.groupBy(*G).agg((F.count_if("speech") * HOP).alias("ts"), (F.count_if(~F.col("speech")) * HOP).alias("tn"))
    all_ = base.join(runs, G, "left").join(utt, G, "left").fillna(0, ["sp", "np", "su", "nu"])
    return all_.select(
        *G, *[c for c in (*runs.columns, *utt.columns) if c.rsplit("_", 1)[-1] in ("mean", "std", "min", "max")],
        *scalar4("total_speech_time", "ts", 0), *scalar4("speech_ratio", F.col("ts") / T, 0), *scalar4("total_nonspeech_time", "tn", 0), *scalar4("nonspeech_ratio", F.col("tn") / T, 0),
        *scalar4("pause_ratio", F.col("sp") / T, 0), *scalar4("pause_rate", F.col("np") / T, 0), *scalar4("utterance_ratio", F.col("su") / T, 0), *scalar4("utterance_rate", F.col("nu") / T, 0),
        *scalar4("utterance_pause_ratio", ratio("su", "sp"), 0),
    )


def loudness(sp: DataFrame) -> DataFrame:
    """Decibels of speech frames; the slope runs over the speech frames put together."""
    s = sp.where("speech").withColumns({"db": 20 * F.log10(F.greatest(F.col("rms").cast("double"), F.lit(1e-12))), "t": (F.row_number().over(in_order()) - 1) * HOP})
    return s.groupBy(*G).agg(*stats4("loudness_level", "db", 0), *scalar4("loudness_range", F.expr("percentile(db, 0.95) - percentile(db, 0.05)"), 0), *scalar4("loudness_slope", slope("db", "t"), 0))


def envelope(sp: DataFrame) -> DataFrame:
    """sp with env: the RMS smoothed over 5 frames (zeros beyond the ends), 0 outside speech, and trend: its mean over 50 frames."""
    five = F.sum(F.col("rms").cast("double")).over(in_order().rowsBetween(-2, 2)) / F.least(F.lit(5), F.count("*").over(in_window()))
    e = sp.withColumn("env", F.when(F.col("speech"), five).otherwise(0.0))
    return e.withColumn("trend", F.sum("env").over(in_order().rowsBetween(-25, 24)) / F.least(F.lit(50), F.count("*").over(in_window())))


def tremor_extent(env: DataFrame) -> DataFrame:
    rest = F.col("env") - F.col("trend")
    return env.groupBy(*G).agg(*scalar4("amplitude_tremor_extent", F.sqrt(F.avg(rest * rest)), 0))


def sequences(env: DataFrame) -> DataFrame:
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("i", c.alias("y")))), lambda x: x["y"])
    return env.groupBy(*G).agg(ordered(F.col("env")).alias("e"), ordered(F.col("env") - F.col("trend")).alias("r"), (F.count_if("speech") * HOP).alias("ts"))


def syllables(env: DataFrame) -> DataFrame:
    s = sequences(env).withColumn("n", spectral.count_syllables("e"))
    return s.select(*G, *scalar4("speech_velocity", ratio("n", "ts"), 0))


def rhythm(env: DataFrame) -> DataFrame:
    hz = lambda c, lo, hi: spectral.band_rhythm(c, F.lit(100.0), F.lit(lo), F.lit(hi))
    s = sequences(env).withColumns({"_e": hz("e", 0.5, 12.0), "_r": hz("r", 3.0, 12.0)})
    return s.select(*G, *scalar4("envelope_rhythm_rate", "_e.rate", 0), *scalar4("envelope_rhythm_spectral_entropy", "_e.entropy", 0), *scalar4("envelope_rhythm_regularity", "_e.regularity", 0), *scalar4("amplitude_tremor_rate", "_r.rate", 0))


def pitch(sp: DataFrame) -> DataFrame:
    """Pitch of voiced speech frames (f0 found). Frames without pitch tracks (f0 null in all) give nulls."""
    v = sp.where("speech").withColumn("voiced", F.coalesce(F.col("f0") > 0, F.lit(False)) & ~F.isnan(F.coalesce("f0", F.lit(0.0))))
    v = v.withColumn("_broke", F.lag("voiced").over(in_order()) & ~F.col("voiced"))
    f = F.when(F.col("voiced"), F.col("f0"))
    n, k = F.count("*"), F.count_if("voiced")
    g = v.groupBy(*G).agg(
        *stats4("pitch_level_f0", f, 0), F.transform(F.array_sort(F.collect_list(F.when(F.col("voiced"), F.struct("i", "f0")))), lambda x: x["f0"]).alias("_f"),
        *scalar4("voiced_ratio", F.when(k > 0, k / n), 0), *scalar4("unvoiced_ratio", F.when(k > 0, 1 - k / n), 0), *scalar4("voicing_breaks_rate", F.when((k > 0) & (n >= 2), F.count_if("_broke") / (n * HOP)), 0),
    )
    g = g.withColumn("_p", spectral.pitch_shape("_f"))
    names = (("pitch_variability", "variability"), ("pitch_range", "span"), ("pitch_tremor_extent", "extent"), ("pitch_tremor_rate", "rate"))
    return g.select(*[c for c in g.columns if c not in ("_f", "_p")], *(c for name, field in names for c in scalar4(name, F.col(f"_p.{field}"), 0)))


UNDEFINED = ("dynamic_time_warping_similarity", "frequency_domain_similarity", "rouge_l_similarity")


def undefined() -> list:
    """Indicators that are declared without a definition: always null."""
    return [c for n in UNDEFINED for c in null4(n)]


def window_indicators(windowed: DataFrame, cfg: PIConfig) -> DataFrame:
    """All indicators from windowed frames (sess, win, i, rms, f0)."""
    sp = speech(windowed)
    env = envelope(sp)
    out = pause_stats(pauses(sp), cfg)
    for part in (loudness(sp), syllables(env), rhythm(env), tremor_extent(env), pitch(sp)):
        out = out.join(part, G, "left")
    return out.select("*", *undefined())


def indicators(frames: DataFrame, cfg: PIConfig) -> DataFrame:
    return window_indicators(windows(frames, cfg), cfg)
