"""Scans over raw observation documents and their flattenings.

Every scan takes the nested frame and returns flat columns; only the nested leaves a
scan names are read from Parquet. Where the landed table has the top-level ``lon``,
``lat`` and ``date`` columns that ``sinks.append_observations`` adds, the box and day
predicates prune partitions and row groups as well.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions.geo import point
from curbline.functions.timing import Interval, seconds_between, ts
from curbline.regions import REGIONS, Region, assign_regions, in_any
from curbline.schema import OBSERVATION_DDL


# The landed table adds what scans prune by.
LANDED_DDL = f"{OBSERVATION_DDL}, lon double, lat double, part string, date date"


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """The landed observation table, one directory per part and collection date."""
    return spark.read.schema(LANDED_DDL).parquet(path).drop("part")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files holding one JSON array of observation documents each."""
    return (spark.read.schema(OBSERVATION_DDL).option("multiLine", True)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").json(path))


def _lon_lat(df: DataFrame) -> tuple[Column, Column]:
    if {"lon", "lat"} <= set(df.columns):
        return F.col("lon"), F.col("lat")
    return F.col("geometry.coordinates")[0], F.col("geometry.coordinates")[1]


def _selected(obs: DataFrame, interval: Interval | None, regions: Sequence[Region]) -> DataFrame:
    if {"lon", "lat"} <= set(obs.columns):
        obs = obs.where(in_any(F.col("lon"), F.col("lat"), regions))
    if interval is None:
        return obs
    if "date" in obs.columns:
        obs = obs.where(interval.dates_of(F.col("date")))
    return obs.where(interval.strictly_inside(F.col("_meta_runtime_utc")))


def scan_points(obs: DataFrame, interval: Interval | None = None,
                regions: Sequence[Region] = REGIONS) -> DataFrame:
    """Positions per region: the top-level id, provider, provider time and coordinates."""
    lon, lat = _lon_lat(obs)
    flat = _selected(obs, interval, regions).select(
        "id", F.col("properties.provider.name").alias("provider"),
        F.col("_meta_last_updated_utc").alias("time"),
        F.col("_meta_runtime_utc").alias("runtime"),
        lon.alias("lon"), lat.alias("lat"))
    return assign_regions(flat, regions=regions)


def _flag(column: str) -> Column:
    return F.coalesce(F.col(column).cast("int"), F.lit(0))


def scan_status(obs: DataFrame, interval: Interval | None = None,
                regions: Sequence[Region] = REGIONS) -> DataFrame:
    """Availability per region, keyed by the vehicle id inside ``properties``."""
    lon, lat = _lon_lat(obs)
    flat = _selected(obs, interval, regions).select(
        F.col("properties.id").alias("id"), F.col("properties.provider.name").alias("provider"),
        F.col("_meta_runtime_utc").alias("runtime"),
        seconds_between(F.col("_meta_last_updated_utc"), F.col("_meta_runtime_utc")).alias("delta_updated"),
        F.lit(1).alias("available"),
        _flag("properties.vehicle.status.disabled").alias("disabled"),
        _flag("properties.vehicle.status.reserved").alias("reserved"),
        lon.alias("lon"), lat.alias("lat"))
    return assign_regions(flat, regions=regions).drop("lon", "lat")


def scan_sightings(obs: DataFrame, interval: Interval | None = None,
                   regions: Sequence[Region] = REGIONS) -> DataFrame:
    """When each vehicle (id inside ``properties``) was seen, per region."""
    lon, lat = _lon_lat(obs)
    flat = _selected(obs, interval, regions).select(
        F.col("properties.id").alias("id"), F.col("properties.provider.name").alias("provider"),
        F.col("_meta_last_updated_utc").alias("time"), lon.alias("lon"), lat.alias("lat"))
    return assign_regions(flat, regions=regions).drop("lon", "lat")


def _required(parent: str, leaf: str) -> Column:
    """``parent.leaf``; a row without the parent document fails the query."""
    message = F.concat(F.lit(f"document without {parent}, id "), F.coalesce(F.col("id"), F.lit("null")))
    return F.when(F.col(parent).isNull(), F.raise_error(message)).otherwise(F.col(f"{parent}.{leaf}"))


def explore(obs: DataFrame, lat: tuple[float, float] | None = None, lon: tuple[float, float] | None = None,
            timerange: tuple[dt.datetime | str, dt.datetime | str] | None = None,
            ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Flat datapoints under optional filters, all of them exclusive and AND-ed.

    ``ids`` may be a short list or a frame with an ``id`` column. No filter returns
    every row.
    """
    x, y = _lon_lat(obs)
    refreshed = F.col("_meta_last_updated_utc")
    tests = []
    if lat is not None:
        tests.append((y > lat[0]) & (y < lat[1]))
    if lon is not None:
        tests.append((x > lon[0]) & (x < lon[1]))
    if timerange is not None:
        tests.append((refreshed > ts(timerange[0])) & (refreshed < ts(timerange[1])))
    if ids is not None and not isinstance(ids, DataFrame):
        tests.append(F.col("id").isin(list(ids)))
    rows = obs.where(reduce(and_, tests)) if tests else obs
    if isinstance(ids, DataFrame):
        rows = rows.join(ids.select("id").distinct(), "id", "left_semi")
    return rows.select(
        refreshed.alias("time_provider"), F.col("_meta_runtime_utc").alias("time_airflow"), "id",
        x.alias("lon"), y.alias("lat"),
        _required("properties.provider", "id").alias("provider"),
        F.col("properties.available").alias("is_available"),
        _required("properties.vehicle.status", "disabled").alias("is_disabled"),
        _required("properties.vehicle.status", "reserved").alias("is_reserved"),
    ).withColumn("geometry", point(F.col("lon"), F.col("lat")))
