"""One registered query per operator, over whole tables, with its result digests."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import (decontamination, exact_dedup, filter_audit, fingerprints, lexical_search, near_dup, oracles,
                       packing, pii, quality, sharding, substring_dedup, token_output, url_filter)
from skein.llm.common import id_and_text, table
from skein.session import ensure_checkpoint_dir

NEAR_DUP_THRESHOLD = 0.85


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    token_output.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_ids(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = id_and_text(table(spark, sf_dir, "documents")).select("doc_id", pii.spans(F.col("text")).alias("all"))
    found = found.withColumn("base", F.filter("all", lambda s: s["base"]))
    counts = [pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.col("all")).alias("spans"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_with_next(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
                        fingerprints.as_text(F.col("marks")).alias("fingerprint"),
                        fingerprints.as_text(F.col("edited_marks")).alias("edited_fingerprint"),
                        "near_edited", "near_next")


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), NEAR_DUP_THRESHOLD).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_token_output, op3_packing, op4_url_filter, op5_pii, op6_fingerprints,
    op7_near_dup, op8_sharding, op9_substring_dedup, op10_quality, op11_lexical_search, op12_filter_audit,
    op13_exact_dedup)}
ORACLES: dict[str, str] = {
    "op11_lexical_search": oracles.LEXICAL_SEARCH,
    "op12_filter_audit": oracles.FILTER_AUDIT,
    "op13_exact_dedup": oracles.EXACT_DEDUP,
}
