"""Collection: landed pages plus the provider feed become observation documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.session import broadcast_if_small
from curbline.sources.feeds import VEHICLE_TYPE, latest, offers

# A broadcast provider takes about this many bytes in a hash relation.
PROVIDER_BYTES = 200


def enrich(pages: DataFrame, feed: DataFrame, run_time: Column, vehicle_type: str = VEHICLE_TYPE) -> DataFrame:
    """Vehicles of the providers that offer the type, with run time and provider refresh time.

    Of several feed rows of a provider the latest refresh counts. A vehicle whose provider is
    not in the feed at all fails the job, whichever columns are read.
    """
    known = broadcast_if_small(latest(feed).select(F.col("provider_id").alias("_provider"), offers(F.col("vehicle_type"), vehicle_type)
                               .alias("_offers"), F.col("last_updated").alias("_refreshed")), PROVIDER_BYTES)
    provider = F.col("properties.provider.id")
    missing = F.raise_error(F.concat(F.lit("provider not in feed: "), F.coalesce(provider, F.lit("null"))))
    joined = pages.join(known, provider == F.col("_provider"), "left")
    return (joined.where(F.when(F.col("_provider").isNull(), missing.cast("boolean")).otherwise(F.col("_offers")))
            .withColumn("_meta_runtime_utc", run_time)
            .withColumn("_meta_last_updated_utc", F.timestamp_seconds("_refreshed"))
            .withColumn("properties", F.col("properties").dropFields("provider.apps"))
            .drop("_provider", "_offers", "_refreshed"))
