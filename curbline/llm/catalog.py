"""One query per operator, over the whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import (chat, divergence, exact_dedup, line_dedup, lm_score, merkle, packing, prefix_bpe, sharding, simhash, sketch,
                          suffix_dedup, toxicity)
from curbline.llm.common import documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lm_score.score_documents(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir))


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_groups(documents(spark, sf_dir))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
                          F.col("first.doc_id").alias("component_id"))


def op6_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.edited_fingerprints(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                         "grown_shard")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(documents(spark, sf_dir))
    # A cut may leave part of a character; the text shows it as a replacement sign.
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.score_documents(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    return merkle.manifest(documents(spark, sf_dir), altered={"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, where=tampered)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.read_back(stored.select("conv_id", "turn", "role", "text").unionByName(added))


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_line_dedup, op2_lm_score, op3_packing, op4_prefix_bpe, op5_simhash, op6_sketch, op7_sharding,
             op8_exact_dedup, op9_suffix_dedup, op10_toxicity, op11_source_divergence, op12_merkle, op13_chat]
    return {query.__name__: query for query in found}


def oracles() -> dict[str, str]:
    return {"op8_exact_dedup": exact_dedup.ORACLE_SQL, "op11_source_divergence": divergence.ORACLE_SQL}
