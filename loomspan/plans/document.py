"""Nested documents and their files."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from loomspan.operators.windows import dealt

from . import registry
from .config import PIConfig

FILES = {"eye-tracking": "eye-tracking_pi.json", "keyboard": "keyboard_pi.json", "touch": "touch_pi.json", "voice": "voice_pi.json"}
UNIT = {"eye-tracking": 1000, "keyboard": 1, "touch": 1, "voice": 1}


def keyed(wide: DataFrame, task: Column) -> DataFrame:
    """Adds client_id, task, date and archive_id to the rows of sessions that have only a number; times are taken as UTC."""
    return wide.select("*", F.col("sess").cast("string").alias("client_id"), task.alias("task"), F.lit("").alias("date"), F.lit("").alias("archive_id"))


def iso(us: Column, offset: Column) -> Column:
    """yyyy-mm-ddThh:mm:ss.ffffff with the offset (minutes) as +hh, or +hh:mm where it has minutes."""
    at = F.timestamp_micros(us + offset.cast("long") * 60_000_000)
    sign, m = F.when(offset < 0, "-").otherwise("+"), F.abs(offset)
    tail = F.concat(sign, F.lpad(F.floor(m / 60).cast("string"), 2, "0"), F.when(m % 60 == 0, "").otherwise(F.concat(F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"))))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), tail)


def zone_minutes(us: Column, zone: str) -> Column:
    """A zone's offset from UTC at an instant, in minutes: summer time counts where and when it holds."""
    at = F.timestamp_micros(us)
    return ((F.unix_micros(F.from_utc_timestamp(at, zone)) - us) / 60_000_000).cast("int")


def documents(wide: DataFrame, modality: str, cfg: PIConfig, offset_minutes: int | Column = 0, samples: int = 0) -> DataFrame:
    """One row for each session: its keys and document (JSON, nulls kept). Windows without samples are in it only for modalities that emit them.

    Times are rendered at offset_minutes from UTC; where it is null, in the zone of cfg at that time. wide has client_id, task, date, archive_id, win, w_start, w_end in epoch units of the modality (ms for gaze, else us), and the indicators. samples, where known, is how many samples wide was made of: sessions are dealt to as many tasks as that takes.
    """
    offset = F.lit(offset_minutes) if isinstance(offset_minutes, int) else offset_minutes
    scale = UNIT[modality]
    us = lambda c: F.col(c).cast("long") * scale
    when = lambda c: iso(us(c), F.coalesce(offset, zone_minutes(us(c), cfg.timezone)))
    pi = F.struct(*(F.col(c) for c in registry.columns(modality)))
    window = F.struct(F.col("win").alias("window_number"), when("w_start").alias("start_timestamp"), when("w_end").alias("end_timestamp"), pi.alias("pi"))
    if samples:
        wide = dealt(wide, samples, "sess", share=20_000)
    rows = wide.groupBy("sess", "client_id", "task", "date", "archive_id").agg(F.array_sort(F.collect_list(F.when(F.col("win").isNotNull(), window))).alias("windows"))
    screen = F.struct(F.lit(cfg.screen_w).alias("width"), F.lit(cfg.screen_h).alias("height"))
    doc = F.struct("client_id", F.col("task").alias("context"), F.lit(modality).alias("sensor_modality"), screen.alias("screen"), "windows")
    return rows.select("sess", "client_id", "task", "date", "archive_id", F.to_json(doc, {"ignoreNullFields": "false"}).alias("document"))


def winners(docs: DataFrame) -> DataFrame:
    """One document for each client and task: of the latest date, then the last archive."""
    last = Window.partitionBy("client_id", "task").orderBy(F.desc("date"), F.desc("archive_id"), F.desc("sess"))
    return docs.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def storage(root: str):
    """(file system, path) of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


@dataclass
class Written(WriterCommitMessage):
    """What a task attempt has written: each file's temporary and its final path."""

    files: list


class DocumentWriter(DataSourceWriter):
    """Documents as files that appear when all tasks have succeeded: an attempt writes files of its own names, which are renamed at commit and removed at abort. A second attempt of a task, or a speculative copy, writes beside the first, and only the attempt that Spark commits is renamed."""

    def __init__(self, root: str, name: str):
        self.root, self.name = root, name

    def write(self, rows):
        system, base = storage(self.root)
        done: list = []
        try:
            for row in rows:
                folder = f"{base}/{row.client_id}/{row.task}"
                own = f"{folder}/.{self.name}.{uuid.uuid4().hex}"
                text = json.dumps(json.loads(row.document), ensure_ascii=False, indent=2).encode()
                system.create_dir(folder, recursive=True)
                done.append((own, f"{folder}/{self.name}"))
                with system.open_output_stream(own) as f:
                    f.write(text)
        except BaseException:
            self.remove(system, done)
            raise
        return Written(done)

    @staticmethod
    def remove(system, done) -> None:
        from pyarrow import fs

        for own, _ in done:
            if system.get_file_info(own).type == fs.FileType.File:
                system.delete_file(own)

    def commit(self, messages) -> None:
        system, _ = storage(self.root)
        for message in messages:
            for own, final in message.files:
                system.move(own, final)

    def abort(self, messages) -> None:
        system, _ = storage(self.root)
        for message in messages:
            if message is not None:
                self.remove(system, message.files)


class DocumentSink(DataSource):
    """Sink of rows client_id, task, document. Options: root (a folder that all executors share) and file (the documents' name)."""

    @classmethod
    def name(cls) -> str:
        return "loomspan_documents"

    def schema(self) -> str:
        return "client_id string, task string, document string"

    def writer(self, schema, overwrite) -> DocumentWriter:
        return DocumentWriter(self.options["root"], self.options["file"])


def write_documents(docs: DataFrame, root: str, modality: str) -> int:
    """Writes <root>/<client>/<task>/<modality>_pi.json for every winner from the executors; returns how many. root is a folder that all executors share. A failed run leaves what was there before."""
    docs.sparkSession.dataSource.register(DocumentSink)
    seen = Observation()
    counted = winners(docs).select("client_id", "task", "document").observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(DocumentSink.name()).option("root", root).option("file", FILES[modality]).mode("append").save()
    return seen.get["n"]
