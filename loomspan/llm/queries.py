"""The thin queries over these operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, licenses, lm, manifest, packing, pii, quality, shard, simhash, sketch, suffix, warc

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ctw_score(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


def op2_golay_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_anchor_pii(spark, sf_dir):
    return pii.digest(pii.scan(table(spark, sf_dir, "documents")))


def op4_best_fit(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_rendezvous(spark, sf_dir):
    return shard.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op6_host_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_warc_index(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_segment_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_bwt_repeats(spark, sf_dir):
    return suffix.deduplicate(table(spark, sf_dir, "documents"))


def op10_bloom_sketch(spark, sf_dir):
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op11_license_index(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_group_tiles(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return manifest.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ctw_score, op2_golay_simhash, op3_anchor_pii, op4_best_fit, op5_rendezvous, op6_host_rules, op7_warc_index, op8_segment_bpe, op9_bwt_repeats, op10_bloom_sketch, op11_license_index, op12_group_tiles,
        op13_merkle_manifest,
    )
}
SQL = {
    "op5_rendezvous": shard.oracle(SHARDS), "op6_host_rules": quality.ORACLE, "op7_warc_index": warc.ORACLE, "op11_license_index": licenses.oracle(), "op12_group_tiles": divergence.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
