"""Landed collection files: vehicle pages and the provider feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.schema import PAGE_DDL, PROVIDER_FEED_DDL

# Fixed value: the vehicle type that is collected.
VEHICLE_TYPE = "E-Scooter"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All vehicles of all landed pages. Each file is one JSON array; a file that is no JSON
    array counts as an empty page and is listed by ``rejected_pages``.

    Documents are parsed one by one: a value of the wrong kind is null in its own row and
    leaves the other values and documents as they are. A document without an id is kept.
    """
    return _vehicles(spark.read, path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return _vehicles(spark.readStream.option("maxFilesPerTrigger", files_per_batch), path)


def _documents(reader, path: str) -> DataFrame:
    """Files with their text and the texts of the documents in it; null if it is no array."""
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value", F.from_json("value", "array<string>").alias("documents"))


def _vehicles(reader, path: str) -> DataFrame:
    document = F.explode(F.filter("documents", _is_object)).alias("document")
    return _documents(reader, path).select(document).select(F.from_json("document", PAGE_DDL).alias("vehicle")).select("vehicle.*")


def _is_object(document: Column) -> Column:
    return F.coalesce(F.ltrim(document).startswith("{"), F.lit(False))


def rejected_pages(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_pages`` could not use: per file, whether it is no JSON array, and the number
    of entries in it that are null or no JSON object."""
    rows = _documents(spark.read, path)
    strange = F.size(F.filter("documents", lambda d: ~_is_object(d)))
    return (rows.select("file", F.col("documents").isNull().alias("no_array"),
                        F.when(F.col("documents").isNull(), 0).otherwise(strange).alias("strange_documents"))
            .where("no_array OR strange_documents > 0"))


def latest(feed: DataFrame) -> DataFrame:
    """One row per provider: of several, the one refreshed last."""
    row = F.struct("last_updated", "vehicle_type")
    return (feed.groupBy("provider_id").agg(F.max(row).alias("row"))
            .select("provider_id", "row.vehicle_type", "row.last_updated"))


def read_provider_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROVIDER_FEED_DDL).option("multiLine", True).json(path)


def offers(types: Column, vehicle_type: str = VEHICLE_TYPE) -> Column:
    """Whether a provider's type list names the type; a missing list does not."""
    return F.array_contains(F.coalesce(types, F.array().cast("array<string>")), vehicle_type)


def offering(feed: DataFrame, vehicle_type: str = VEHICLE_TYPE) -> DataFrame:
    return feed.where(offers(F.col("vehicle_type"), vehicle_type))
