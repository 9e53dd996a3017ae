"""Training-data pipeline over documents: quality rules, near-duplicates, repeated passages, personal data, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import packing, pii, quality, similar, suffix
from loomspan.llm.blocks import fresh, shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level rules keep. Null, empty and blank texts have too few words and go; repeated rows are judged alike."""
    return quality.keep(docs).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id (null is the least), of each group of near copies: five-word shingles with a Jaccard similarity of 0.8 or more. Texts without words are one group; rows equal in id and text stand or go together."""
    return similar.keep_first(docs).select(*docs.columns)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start earlier elsewhere; a document that has nothing left goes. Texts that are null or empty to begin with stay as they are."""
    empty = fresh(docs, "empty")
    left = suffix.strip(docs.withColumn(empty, F.coalesce(F.col("text") == "", F.lit(True))))
    return left.where(F.col(empty) | (F.col("text") != "")).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked. Null texts stay null; every row is kept."""
    return pii.redact(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the documents' pieces: one row for each piece. Null and empty texts are one piece of size 0; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("near_dup", near_dup_stage), ("passages", passage_stage), ("pii", pii_stage), ("packing", packing_stage)]

#: Near-duplicates, passages and packing go beyond SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_dir(spark)
    for name, stage in STAGES:
        out = f"{base}/{name}-{uuid.uuid4().hex[:8]}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
