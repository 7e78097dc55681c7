"""Queries that go through stored tables and landed files, each run repeated over part of its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import schema
from curbline.functions.timing import Interval
from curbline.operators import marts, paths, stats, stays
from curbline.session import scratch_path
from curbline.sources import event_views as ev
from curbline.sources import feeds, observations
from curbline.sources.warehouse import Warehouse, append_observations

FIRST_PART = Interval.of("2024-01-01", "2024-01-16")
EARLY = Interval.of("2024-01-01", "2024-01-20")
LATE = Interval.of("2024-01-10", "2024-02-01")
# The second run is repeated, which must change nothing.
RUNS = (EARLY, LATE, LATE)
PAGE_ROWS = 500


def _m(column: str) -> Column:
    return F.round(column, 3).alias(column)


def _deg(column: str, name: str) -> Column:
    return F.round(column, 6).alias(name)


def _store(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "tables"))


def _path_rows(spark: SparkSession, sf_dir: str, interval: Interval = ev.JANUARY) -> DataFrame:
    found = ev.path_view(stays.segment(observations.scan_points(ev.observations(spark, sf_dir), interval)))
    return paths.one_region_per_key(found.withColumn("path_bike_since_last", F.col("path_walk_since_last")))


def _stored_path(spark: SparkSession, sf_dir: str) -> Warehouse:
    store = _store(spark)
    store.upsert(schema.PATH, _path_rows(spark, sf_dir))
    return store


def table_path(spark, sf_dir):
    """Path rows of two overlapping runs; a row of the later run replaces the same one of the earlier."""
    store = _store(spark)
    for part in RUNS:
        store.upsert(schema.PATH, _path_rows(spark, sf_dir, part))
    return store.read(schema.PATH).select(
        "id", "provider", "city_bfs_id", _deg("point.x", "lon"), _deg("point.y", "lat"), "time_from", "time_to",
        _m("distance_m"), "moving", _m("distance_m_walk"), _m("distance_m_bike"),
        F.size("path_walk_since_last").alias("walk_vertices"), F.size("path_bike_since_last").alias("bike_vertices"))


def table_provider_stats(spark, sf_dir):
    store = _store(spark)
    for part in RUNS:
        status = observations.scan_status(ev.observations(spark, sf_dir), part)
        store.upsert(schema.PROVIDER_STATS, stats.provider_stats(status))
    return store.read(schema.PROVIDER_STATS).withColumn("avg_delta_updated", F.round("avg_delta_updated", 6))


def table_edges(spark, sf_dir):
    """Edges of two overlapping runs over the stored paths; the later run replaces whole paths."""
    store = _stored_path(spark, sf_dir)
    for part in RUNS:
        store.upsert(schema.MART_EDGES, marts.edges(store.read(schema.PATH, part.start, part.end), part))
    return store.read(schema.MART_EDGES).select(
        "id", "provider", "city_bfs_id", "time_from", "time_to", "path_idx",
        _deg("point.x", "lon"), _deg("point.y", "lat"),
        _deg("point_before.x", "lon_before"), _deg("point_before.y", "lat_before"), _m("distance_m"))


def table_distinct_ids(spark, sf_dir):
    """All days at once, then one day again."""
    store = _stored_path(spark, sf_dir)
    store.upsert(schema.MART_DISTINCT_IDS, marts.distinct_vehicles(store.read(schema.PATH)))
    moment = ev.MID_JANUARY.start
    store.upsert(schema.MART_DISTINCT_IDS, marts.distinct_vehicles(store.read(schema.PATH, moment, moment), moment))
    return store.read(schema.MART_DISTINCT_IDS)


def table_vehicle_age(spark, sf_dir):
    store = _stored_path(spark, sf_dir)
    for part in RUNS:
        store.upsert(schema.MART_VEHICLE_AGE, marts.vehicle_age(store.read(schema.PATH, last=part.end), part))
    return store.read(schema.MART_VEHICLE_AGE).withColumn("avg_age_days_scooter", F.round("avg_age_days_scooter", 6))


def table_trip_distance(spark, sf_dir):
    """Trips of two runs that meet; a trip that goes on in the second has its part there."""
    store = _stored_path(spark, sf_dir)
    for part in (FIRST_PART, ev.MID_JANUARY, ev.MID_JANUARY):
        trips = marts.trip_distance(store.read(schema.PATH, last=part.end), part)
        store.upsert(schema.MART_TRIP_DISTANCE, marts.one_row_per_trip(trips))
    return store.read(schema.MART_TRIP_DISTANCE).withColumns(
        {c: F.round(c, 3) for c in ("trip_walk_distance_m", "trip_bike_distance_m")})


def table_retention(spark, sf_dir):
    store = _stored_path(spark, sf_dir)
    store.delete_older(schema.PATH, "time_from", "2024-01-15", 230)
    return store.read(schema.PATH).select("id", "city_bfs_id", "time_from", "time_to")


def landed_scan(spark, sf_dir):
    """Points of the landed table, whose one part was written twice."""
    path = scratch_path(spark, "landed")
    for _ in range(2):
        append_observations(ev.observations(spark, sf_dir), path, "january")
    rows = observations.scan_points(observations.read_observations(spark, path), ev.JANUARY)
    return rows.select("city_bfs_id", "id", "provider", "time", "runtime", _deg("lon", "lon"), _deg("lat", "lat"))


def land(rows: DataFrame, document: Column, label: str) -> str:
    """Write the documents as JSON arrays, one file a page, and return the files' pattern."""
    # As many pages as keep one at about PAGE_ROWS documents, however many rows there are.
    pages = rows.count() // PAGE_ROWS + 1
    path = scratch_path(rows.sparkSession, label)
    (rows.select(document.alias("document")).groupBy(F.pmod(F.xxhash64("document"), F.lit(pages)).alias("page"))
     .agg(F.collect_list("document").alias("documents"))
     .select("page", F.concat(F.lit("["), F.concat_ws(",\n", "documents"), F.lit("]")).alias("value"))
     .repartition("page").write.partitionBy("page").text(path))
    return f"{path}/*"


def landed_documents(spark, sf_dir):
    """Points of observation documents in JSON files, whose times are whole seconds."""
    document = F.to_json(F.struct("id", "geometry", "properties", "_meta_runtime_utc", "_meta_last_updated_utc"),
                         {"timestampFormat": "yyyy-MM-dd HH:mm:ss"})
    rows = observations.read_documents(spark, land(ev.observations(spark, sf_dir), document, "documents"))
    return observations.scan_points(rows).select(
        "city_bfs_id", "id", "provider", "time", "runtime", _deg("lon", "lon"), _deg("lat", "lat"))


def landed_feed(spark, sf_dir):
    """Offering providers of two landed feeds; in the older one the second provider still offers."""
    feed = ev.provider_feed(spark, sf_dir)
    before = feed.withColumns({"last_updated": F.col("last_updated") - 600, "vehicle_type": F.array(F.lit(feeds.VEHICLE_TYPE))})
    document = F.to_json(F.struct("provider_id", "vehicle_type", "last_updated"))
    files = land(before.unionByName(feed), document, "feeds")
    return feeds.offering(feeds.latest(feeds.read_provider_feed(spark, files))).select("provider_id", "last_updated")


def explore_ids(spark, sf_dir):
    """All rows of the vehicles that were seen near the zero meridian at any time."""
    rows = ev.observations(spark, sf_dir)
    there = observations.explore(rows, lon=(-1.0, 1.0)).select("id")
    return observations.explore(rows, ids=there).select(
        "time_provider", "time_airflow", "id", _deg("lon", "lon"), _deg("lat", "lat"), "provider",
        "is_available", "is_disabled", "is_reserved")


QUERIES = (table_path, table_provider_stats, table_edges, table_distinct_ids, table_vehicle_age, table_trip_distance,
           table_retention, landed_scan, landed_documents, landed_feed, explore_ids)
