"""Recordings as files: discovery, path keys, CSV and WAV readers.

A file is one row of Spark's binaryFile source and is parsed by one task, as CSV files differ in the order and presence
of their columns, and the order of their rows matters. Conditions on a path's parts are put on the file's metadata, so the
scan leaves other files out when it is planned; their contents are never read. What is parsed is held in the shared folder,
so that each file is parsed once however many indicators are made of it.
"""

from __future__ import annotations

import csv
import io
import struct
import tempfile
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import tokens
from loomspan.functions.spectral import tracked

NAMES = {"eye-tracking": "eye-tracking.csv", "keyboard": "keyboard.csv", "touch": "stylus.csv", "voice": "voice.wav"}
FOLDERS = {"eye-tracking": "eye-tracking", "keyboard": "keyboard", "touch": "stylus", "voice": "voice"}
CELLS = "path string, ord long, names array<string>, cells map<string,string>"


def any_case(name: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in name)


def discover(spark: SparkSession, base: str, modality: str) -> DataFrame:
    """path, modificationTime, content of the modality's files below base. Gaze files are matched by exact name, others in any case."""
    name = NAMES[modality]
    glob = name if modality == "eye-tracking" else any_case(name)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(base)


def keys_of(path: Column, base: str, modality: str) -> dict[str, Column]:
    """date, client_id, task and archive_id from a path below base, and `fits`: whether the path has a place for them.

    Gaze: date/client/task/eye-tracking/archive/file, exactly. Others: around the first folder named after the modality, with unknown_* where the path is short.
    """
    root = base.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    p = F.split(F.substr(path, F.instr(path, F.lit(root)) + len(root)), "/")
    if modality == "eye-tracking":
        at = {"date": 0, "client_id": 1, "task": 2, "archive_id": 4}
        return {n: F.get(p, F.lit(i)) for n, i in at.items()} | {"fits": (F.size(p) >= 6) & (F.get(p, F.lit(3)) == "eye-tracking")}
    i = F.array_position(F.transform(p, F.lower), FOLDERS[modality]).cast("int") - 1
    pick = lambda d, other: F.coalesce(F.when(i + d >= 0, F.get(p, i + d)), F.lit(other))
    return {"date": pick(-3, "unknown_date"), "client_id": pick(-2, "unknown_client"), "task": pick(-1, "unknown_task"), "archive_id": pick(1, "unknown_uuid"), "fits": i >= 0}


def path_keys(files: DataFrame, base: str, modality: str) -> DataFrame:
    """files with date, client_id, task, archive_id from the path; rows whose path has no place for them are left out."""
    keys = keys_of(F.col("path"), base, modality)
    return files.where(keys.pop("fits")).withColumns(keys)


def sessions(spark: SparkSession, base: str, modality: str, clients: list[str] | None = None) -> DataFrame:
    """path, modificationTime, content and keys of the recordings, of the given clients alone if any are named: other files are not read."""
    # a metadata path is a URI
    stored = keys_of(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), base, modality)
    found = discover(spark, base, modality).where(stored["fits"])
    if clients:
        found = found.where(stored["client_id"].isin(*clients))
    return path_keys(found, base, modality)


def held(df: DataFrame) -> DataFrame:
    """df, materialised in spark.checkpoint.dir. Where that is unset, a session of one machine gets a temporary folder; a cluster is refused, as its executors would not share it."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not base:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="loomspan-")
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint()


def cells(files: DataFrame) -> DataFrame:
    """Rows of CSV files with their place in the file, its header, and their cells by name; a file without rows has one row with null ord."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = csv.reader(io.StringIO(content.decode("utf-8-sig", "replace"), newline=""))
                names = next(rows, [])
                out = [(i, list(zip(names, r, strict=False))) for i, r in enumerate(rows) if r] or [(None, [])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(out)), pa.array([i for i, _ in out], pa.int64()), pa.array([names] * len(out), pa.list_(pa.string())), pa.array([c for _, c in out], pa.map_(pa.string(), pa.string()))],
                    ["path", "ord", "names", "cells"],
                )

    return held(files.select("path", "content").mapInArrow(run, CELLS))


def cell(name: str) -> Column:
    """A cell as text; those that mean missing are null."""
    c = F.element_at("cells", name)
    return F.when(~F.trim(c).isin(*tokens.MISSING), c)


def has(name: str) -> Column:
    return F.array_contains("names", name)


def number(name: str) -> Column:
    return F.expr(f"try_cast(trim(cells['{name}']) AS double)")


def micros(text: Column) -> Column:
    """Epoch microseconds of an ISO-8601 time; without a zone it is UTC. Null if it can't be read."""
    return F.unix_micros(F.try_to_timestamp(text))


def offset_minutes(text: Column) -> Column:
    """Zone offset of an ISO-8601 time in minutes; none: 0."""
    m = lambda i: F.regexp_extract(text, r"T.*([+-])(\d{2}):?(\d{2})?$", i)
    h = F.coalesce(F.nullif(m(2), F.lit("")).cast("int"), F.lit(0)) * 60 + F.coalesce(F.nullif(m(3), F.lit("")).cast("int"), F.lit(0))
    return F.coalesce(F.when(m(1) == "-", -h).otherwise(h), F.lit(0))


def gaze(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, errors): sess (path), ord, t (ms), x, y. A session without a required column, or with a time that can't be read, is in errors (sess, error) and has no samples."""
    c = cells(files)
    missing = ~(has("timestamp") & has("x") & has("y"))
    raw, as_number = cell("timestamp"), number("timestamp")
    flat = c.select(F.col("path").alias("sess"), "ord", missing.alias("missing"), raw.alias("raw"), as_number.alias("n"), number("x").alias("x"), number("y").alias("y"))
    judged = flat.groupBy("sess").agg(F.max("missing").alias("missing"), F.bool_and(F.col("n").isNotNull() | F.col("ord").isNull()).alias("numeric"), F.bool_or(F.col("ord").isNotNull() & (F.col("raw").isNull() | (F.col("n").isNull() & micros(F.col("raw")).isNull()))).alias("bad"))
    judged = judged.withColumn("error", F.when(F.col("missing"), "missing required column").when(F.col("bad"), "unreadable timestamp"))
    t = F.when(F.col("numeric"), F.col("n").cast("long")).otherwise(F.floor(micros(F.col("raw")) / 1000).cast("long"))
    good = flat.where("ord IS NOT NULL").join(judged.where("error IS NULL").select("sess", "numeric"), "sess")
    return good.select("sess", "ord", t.alias("t"), "x", "y"), judged.where("error IS NOT NULL").select("sess", "error")


def presses(files: DataFrame, mode: str = "paired_rows") -> tuple[DataFrame, DataFrame]:
    """(presses, errors): sess, ord, token, down, up (us), hold (ms), offset. Presses come from downTime and upTime, or, without such rows and in event_pairing, from key events."""
    from loomspan.plans.keyboard import pair_events

    if mode not in ("paired_rows", "event_pairing", "auto"):
        raise ValueError("mode must be paired_rows, event_pairing or auto")
    c = cells(files).select(
        F.col("path").alias("sess"), "ord", has("letter").alias("letter"), (has("downTime") & has("upTime")).alias("paired"), has("key_action").alias("acts"), tokens.normalise(F.element_at("cells", "letter")).alias("token"),
        F.element_at("cells", "key_action").alias("action"), number("holdTime").alias("given"), *(micros(cell(n)).alias(n) for n in ("timeStamp", "downTime", "upTime")), offset_minutes(F.coalesce(cell("downTime"), cell("timeStamp"), cell("upTime"))).alias("offset"),
    )
    both = F.col("downTime").isNotNull() & F.col("upTime").isNotNull()
    by = c.groupBy("sess").agg(F.max("letter").alias("letter"), F.max("paired").alias("p"), F.max("acts").alias("a"), F.count_if(both & F.col("paired")).alias("n"), *(F.count(x).alias(f"n_{x}") for x in ("timeStamp", "downTime", "upTime")), F.min_by("offset", "ord").alias("offset"))
    from_rows = F.lit(mode != "event_pairing") & F.col("p") & (F.col("n") > 0)
    by = by.withColumn("way", F.when(~F.col("letter"), "missing letter").when(from_rows, "rows").when(F.col("a"), "events").otherwise("no usable presses"))
    rows = c.drop("letter", "offset").join(by.select("sess", "way", "n_timeStamp", "n_downTime", "offset"), "sess")
    direct = rows.where((F.col("way") == "rows") & both).select("sess", "ord", "token", F.col("downTime").alias("down"), F.col("upTime").alias("up"), F.coalesce("given", (F.col("upTime") - F.col("downTime")) / 1000.0).alias("hold"), "offset")
    t = F.when(F.col("n_timeStamp") > 0, F.col("timeStamp")).when(F.col("n_downTime") > 0, F.col("downTime")).otherwise(F.col("upTime"))
    paired = pair_events(rows.where("way = 'events'").select("sess", "ord", "token", "action", t.alias("t"))).join(by.select("sess", "offset"), "sess").select(direct.columns)
    return direct.unionByName(paired), by.where("way NOT IN ('rows', 'events')").select("sess", F.col("way").alias("error"))


def touches(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, errors): sess, ord, t (us from the first), t_first (epoch us), offset, pi, et, ws, px, py, p, h, w. The time is `it`, else `timeStamp`; one that can't be read spoils its session. Columns that are absent have defaults: no value for measures, 0 for codes."""
    raw = F.when(has("it"), cell("it")).when(has("timeStamp"), cell("timeStamp"))
    code = lambda n: F.coalesce(number(n), F.lit(0.0)).cast("int").alias(n)
    c = cells(files).select(F.col("path").alias("sess"), "ord", (has("it") | has("timeStamp")).alias("timed"), micros(raw).alias("us"), offset_minutes(raw).alias("offset"), *(number(n).alias(n) for n in ("px", "py", "p", "h", "w")), code("et"), code("pi"), code("ws"))
    by = c.groupBy("sess").agg(F.max("timed").alias("timed"), F.bool_or(F.col("ord").isNotNull() & F.col("us").isNull()).alias("bad"), F.min("us").alias("t_first"), F.min_by("offset", "ord").alias("offset"))
    by = by.withColumn("error", F.when(~F.col("timed"), "missing time column").when(F.col("bad"), "unreadable timestamp"))
    good = c.drop("offset").where("ord IS NOT NULL").join(by.where("error IS NULL").select("sess", "t_first", "offset"), "sess")
    return good.select("sess", "ord", (F.col("us") - F.col("t_first")).alias("t"), "t_first", "offset", "pi", "et", "ws", "px", "py", "p", "h", "w"), by.where("error IS NOT NULL").select("sess", "error")


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(mono single-precision signal in [-1, 1], rate) of a PCM (8 to 32 bits) or float WAV; channels are averaged."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form, data = 12, None, b""
    while at + 8 <= len(content):
        name, size = content[at : at + 4], struct.unpack("<I", content[at + 4 : at + 8])[0]
        body = content[at + 8 : at + 8 + size]
        if name == b"fmt ":
            form = struct.unpack("<HHIIHH", body[:16])
            if form[0] == 0xFFFE:  # the real code is the sub-format's
                form = (struct.unpack("<H", body[24:26])[0], *form[1:])
        elif name == b"data":
            data = body
        at += 8 + size + size % 2
    if form is None:
        raise ValueError("no format chunk")
    code, channels, rate, _, _, bits = form
    if code == 3:
        y = np.frombuffer(data[: len(data) // (bits // 8) * (bits // 8)], f"<f{bits // 8}").astype(np.float64)
    elif code == 1 and bits in (8, 16, 24, 32):
        width = bits // 8
        raw = np.frombuffer(data[: len(data) // width * width], np.uint8).reshape(-1, width)
        if bits == 8:
            y = (raw[:, 0].astype(np.float64) - 128) / 128
        else:
            wide = np.zeros((len(raw), 4), np.uint8)
            wide[:, 4 - width :] = raw
            y = wide.view("<i4")[:, 0] / 2.0**31
    else:
        raise ValueError(f"unsupported WAV format {code} with {bits} bits")
    return y[: len(y) // channels * channels].reshape(-1, channels).mean(1).astype(np.float32), rate


def voice_windows(files: DataFrame, window_s: float, stride_s: float) -> tuple[DataFrame, DataFrame]:
    """(frames, errors): sess, win, w_start (epoch us), i, rms, f0 of every window of every file, zero-padded beyond its end. The file's end is its modification time."""

    def run(batches):
        for batch in batches:
            for path, end, content in zip(batch.column("path").to_pylist(), batch.column("end_us").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    y, rate = decode_wav(content)
                except ValueError as e:
                    yield rows(path, None, None, np.zeros(1, np.float32), [None], str(e))
                    continue
                start, size = end - round(len(y) / rate * 1e6), round(window_s * rate)
                k = 0
                while k * stride_s < len(y) / rate:
                    a = round(k * stride_s * rate)
                    part = np.zeros(size, np.float32)
                    held = y[a : a + size]
                    part[: len(held)] = held
                    yield rows(path, k + 1, start + round(k * stride_s * 1e6), *tracked(part, rate), None)
                    k += 1

    def rows(path, win, start, rms, f0, error):
        n = len(rms)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n), pa.array([win] * n, pa.int32()), pa.array([start] * n, pa.int64()), pa.array(np.arange(n)), pa.array(rms, pa.float32()), pa.array(f0, pa.float64()), pa.array([error] * n, pa.string())],
            ["sess", "win", "w_start", "i", "rms", "f0", "error"],
        )

    out = held(files.select("path", F.unix_micros("modificationTime").alias("end_us"), "content").mapInArrow(run, "sess string, win int, w_start long, i long, rms float, f0 double, error string"))
    return out.where("error IS NULL").drop("error"), out.where("error IS NOT NULL").select("sess", "error")


def write_wav(y: np.ndarray, rate: int) -> bytes:
    """A 16-bit mono WAV (tests and examples)."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes((np.clip(y, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()
