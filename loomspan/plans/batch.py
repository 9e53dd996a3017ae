"""Whole runs: files below a folder to indicators, documents and errors."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.sources import files

from . import document, eye, keyboard, registry, touch, voice
from .config import PIConfig

KEYS = ["client_id", "task", "date", "archive_id"]
#: Fixed value: the name of the folder that recordings lie below.
ROOT = "hospital_data"


@dataclass
class Result:
    """wide: one row for each session and window; documents: one for each session; errors: sessions that couldn't be read."""

    wide: DataFrame
    documents: DataFrame
    errors: DataFrame


def from_files(recordings: DataFrame, modality: str, cfg: PIConfig) -> tuple[DataFrame, DataFrame]:
    """(indicators with epoch times and offset, errors) of recordings (path, modificationTime, content). Recordings whose times name no zone have a null offset."""
    if modality == "eye-tracking":
        samples, errors = files.gaze(recordings)
        wide = eye.indicators(samples, cfg).withColumn("offset", F.lit(None).cast("int"))
        lone = samples.select("sess").distinct().join(wide.select("sess").distinct(), "sess", "left_anti")  # a session without windows still has a document
        return wide.unionByName(lone, allowMissingColumns=True), errors
    if modality == "keyboard":
        presses, errors = files.presses(recordings, cfg.holdtime_mode)
        zones = presses.groupBy("sess").agg(F.max("offset").alias("offset"))  # one a session
        return keyboard.indicators(presses.drop("offset"), cfg).join(zones, "sess"), errors
    if modality == "touch":
        events, errors = files.touches(recordings)
        zones = events.groupBy("sess").agg(F.max("t_first").alias("t_first"), F.max("offset").alias("offset"))
        wide = touch.indicators(events.drop("t_first", "offset"), cfg).join(zones, "sess")
        return wide.withColumns({"w_start": F.col("w_start") + F.col("t_first"), "w_end": F.col("w_end") + F.col("t_first")}).drop("t_first"), errors
    frames, errors = files.voice_windows(recordings, cfg.window_s, cfg.stride_s)
    starts = frames.groupBy("sess", "win").agg(F.min("w_start").alias("w_start")).withColumn("w_end", F.col("w_start") + cfg.us(cfg.window_s))
    return voice.window_indicators(frames.drop("w_start"), cfg).join(starts, ["sess", "win"]).withColumn("offset", F.lit(None).cast("int")), errors


def run(spark: SparkSession, base: str, modality: str, cfg: PIConfig | None = None, clients: list[str] | None = None) -> Result:
    """Indicators of every recording of a modality below base (of the named clients, if any)."""
    if modality not in registry.INDICATORS:
        raise ValueError(f"modality must be one of {', '.join(registry.INDICATORS)}")
    cfg = cfg or PIConfig()
    return _run(files.sessions(spark, base, modality, clients), modality, cfg)


def run_file(spark: SparkSession, path: str, modality: str, cfg: PIConfig | None = None, client_id: str = "unknown_client", task: str = "unknown_task") -> Result:
    """Indicators of one recording, whose client and task are given."""
    one = spark.read.format("binaryFile").load(path)
    return _run(one.select("*", F.lit(client_id).alias("client_id"), F.lit(task).alias("task"), F.lit("").alias("date"), F.lit("").alias("archive_id")), modality, cfg or PIConfig())


def _run(recordings: DataFrame, modality: str, cfg: PIConfig) -> Result:
    wide, errors = from_files(recordings, modality, cfg)
    wide = wide.join(recordings.select(F.col("path").alias("sess"), *KEYS), "sess")
    return Result(wide, document.documents(wide, modality, cfg, F.col("offset")), errors)


def output_root(base: str, given: str | None = None, single: bool = False) -> str:
    """The folder of the documents: the given one, else primitive_indicator beside base; of a single recording, beside its ancestor of ROOT's name, else in its folder."""
    if given:
        return given
    path = base.rstrip("/")
    if single:
        parts = path.split("/")
        if ROOT not in parts:
            return os.path.dirname(path)
        path = "/".join(parts[: parts.index(ROOT) + 1])
    return os.path.join(os.path.dirname(path), "primitive_indicator")


def run_and_write(spark: SparkSession, base: str, modality: str, cfg: PIConfig | None = None, clients: list[str] | None = None, root: str | None = None) -> int:
    """Writes every client's and task's document; returns how many."""
    return document.write_documents(run(spark, base, modality, cfg, clients).documents, output_root(base, root), modality)
