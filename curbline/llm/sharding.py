"""Weighted rendezvous hashing of record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import text_rows
from curbline.session import stage

SHARDS = 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key``: the one with the highest ``-weight / ln(u)``, u drawn by key and shard.

    A further shard only takes keys for which it scores highest; no other key moves. Shards get
    keys in proportion to their weights. A weight of zero or less takes none.
    """
    if not any(weight > 0 for weight in weights):
        raise ValueError("no shard has a weight above zero")
    bids = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            draw = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
            bids.append(F.struct((-F.lit(float(weight)) / F.ln(draw)).alias("bid"), F.lit(-shard).alias("shard")))
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return (-best["shard"]).cast("int")


def numbered(rows: DataFrame, shard: str, order: Sequence[str], name: str, blocks: int | None = None) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 within each shard.

    A shard is numbered in blocks by a hash of the row; only one count a block is brought
    together, so no task holds a whole shard.
    """
    spark = rows.sparkSession
    count = blocks or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(count)))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(shard, "_block").agg(F.count("*").alias("_rows"))
              .select(shard, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(shard, "_block").orderBy(*order)
    return (dealt.withColumn("_place", F.row_number().over(inside))
            .join(starts, [shard, "_block"])
            .withColumn(name, F.col("_start") + F.col("_place") - 1)
            .drop("_block", "_place", "_start"))


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown_weight: float = 1.0) -> DataFrame:
    """``rid, doc_id, size, text_crc32, shard, slot, grown_shard`` for every row of ``docs``.

    ``size`` is the UTF-8 length of the text plus one, null text counting as empty. The shard
    follows from ``doc_id`` and the weights alone; null ids are one key, rows with equal ids go
    to one shard. ``grown_shard`` is the shard after one more is added. ``slot`` numbers a
    shard's rows from 0 in an order fixed by their content and place in the table. An empty
    table gives no rows. Only the digest of a text moves.
    """
    sized = text_rows(docs).select("rid", "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
                                   F.crc32("text").alias("text_crc32"))
    placed = stage(sized.withColumn("shard", rendezvous(F.col("doc_id"), weights))
                   .withColumn("grown_shard", rendezvous(F.col("doc_id"), [*weights, grown_weight])), "sharded")
    return numbered(placed, "shard", ["doc_id", "text_crc32", "rid"], "slot")
