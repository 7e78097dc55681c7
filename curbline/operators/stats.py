"""Provider availability and the vehicle registry.

Both are partial aggregations: rows combine before the shuffle, and exact distinct
counts first reduce to one row per distinct value, so a provider that holds a large part
of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = "2 minutes"


def provider_stats(status: DataFrame) -> DataFrame:
    """Two-minute bins per provider and region; only bins with rows, labelled by their start."""
    grouped = status.groupBy("provider", "city_bfs_id", F.window("runtime", BIN).alias("bin")).agg(
        F.count(F.lit(1)).alias("count_datapoints"),
        F.count_distinct("id").alias("count_distinct_ids"),
        F.avg("delta_updated").alias("avg_delta_updated"),
        F.sum("available").alias("count_available"),
        F.sum("disabled").alias("count_disabled"),
        F.sum("reserved").alias("count_reserved"))
    return grouped.select(
        F.col("bin.start").alias("time"), "provider", "city_bfs_id", "count_datapoints",
        "count_distinct_ids", "avg_delta_updated", "count_available", "count_disabled", "count_reserved")


def registry(sightings: DataFrame) -> DataFrame:
    """First and last sighting and number of distinct times per vehicle and provider."""
    return sightings.groupBy("id", "provider", "city_bfs_id").agg(
        F.min("time").alias("first_seen"), F.max("time").alias("last_seen"),
        F.count_distinct("time").alias("datapoints"))


def one_row_per_vehicle(rows: DataFrame) -> DataFrame:
    """Fold registry rows to the table's key; the provider seen last names the vehicle."""
    return rows.groupBy("id", "city_bfs_id").agg(
        F.max(F.struct("last_seen", "provider")).alias("latest"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("datapoints").alias("datapoints"),
    ).select("id", F.col("latest.provider").alias("provider"), "city_bfs_id",
             "first_seen", "last_seen", "datapoints")


def vehicles(points: DataFrame, order: str = "time") -> DataFrame:
    """Distinct vehicles with the provider of their first row."""
    return points.groupBy("id").agg(F.min(F.struct(order, "provider")).alias("first")).select(
        "id", F.col("first.provider").alias("provider"))
