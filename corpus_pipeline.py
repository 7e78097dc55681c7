"""A corpus cleaning pipeline: each stage reads what the one before it wrote."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from curbline.llm import line_dedup, packing, simhash, suffix_dedup, toxicity
from curbline.session import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; all labels may be learned from."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents joined by fingerprints of three words at most three bits apart, the first."""
    return simhash.deduplicated(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_passages(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("SimHash near-dedup", drop_near_copies),
          ("suffix-array dedup", drop_repeated_passages), ("best-fit packing", pack)]

# Learned weights, anchors and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what all stages keep of ``documents``.

    Each stage's result is staged; what a stage wrote on the way is removed with it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES[:-1]):
        docs = settled(spark, f"pipeline-{number}", partial(function, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
