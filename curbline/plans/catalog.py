"""One query per operator, over the whole event table of a scale directory.

Results are scalar columns: coordinates rounded to 6 decimals, metres to 3, times as UTC
wall clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, TimestampType

from curbline import schema
from curbline.functions import geo
from curbline.functions.timing import Interval, ts
from curbline.operators import explore, marts, merge, paths, quality, routing, stats, stays
from curbline.plans import stored
from curbline.plans.collect import enrich
from curbline.plans.stored import EARLY, FIRST_PART, LATE
from curbline.regions import assign_regions
from curbline.session import scratch_path, stage
from curbline.sources import event_views as ev
from curbline.sources import feeds, observations, streets
from curbline.sources.warehouse import Warehouse
from curbline.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = "2024-02-01 02:05:00"
# A point in LV03 metres that distances are measured from.
PLACE = (695538.0, 260803.0)


def _m(column: str | Column, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 3).alias(name or column)


def _deg(column: str | Column, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6).alias(name or column)


def _plain(df: DataFrame) -> DataFrame:
    kinds = {TimestampType: "timestamp_ntz", IntegerType: "bigint"}
    return df.select(*[
        F.col(f.name).cast(kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds else F.col(f.name)
        for f in df.schema])


def _points(spark: SparkSession, sf_dir: str, interval: Interval = ev.JANUARY) -> DataFrame:
    return observations.scan_points(ev.observations(spark, sf_dir), interval)


def _stays(spark: SparkSession, sf_dir: str, interval: Interval = ev.JANUARY) -> DataFrame:
    return stays.segment(_points(spark, sf_dir, interval))


def _path(spark: SparkSession, sf_dir: str, interval: Interval = ev.JANUARY) -> DataFrame:
    return ev.path_view(_stays(spark, sf_dir, interval))


def _datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations.explore(ev.observations(spark, sf_dir))


# Scans, regions, geometry

def observation_scan(spark, sf_dir):
    return _points(spark, sf_dir).select("city_bfs_id", "id", "provider", "time", "runtime", _deg("lon"), _deg("lat"))


def region_counts(spark, sf_dir):
    rows = assign_regions(observations.explore(ev.observations(spark, sf_dir)))
    return rows.groupBy("city_bfs_id").agg(F.count(F.lit(1)).alias("datapoints"),
                                           F.count_distinct("id").alias("vehicles"))


def observation_dedup(spark, sf_dir):
    """Every refresh is seen twice, by the second run at another place; the first run's row stays."""
    once = _points(spark, sf_dir)
    again = once.withColumns({"runtime": F.col("runtime") + F.expr("interval 2 minutes"), "lon": F.col("lon") + 0.001})
    return stays.distinct_observations(once.unionByName(again)).select(
        "city_bfs_id", "id", "provider", "time", _deg("lon"), _deg("lat"))


def reproject_lv03(spark, sf_dir):
    x, y = geo.lv03(F.col("lon"), F.col("lat"))
    there = _points(spark, sf_dir).withColumns({"x": x, "y": y})
    lon, lat = geo.wgs84(F.col("x"), F.col("y"))
    return there.select("city_bfs_id", "id", "time", _m("x"), _m("y"), _deg(lon, "lon_back"), _deg(lat, "lat_back"))


def reproject_mercator(spark, sf_dir):
    mx, my = geo.mercator(F.col("lon"), F.col("lat"))
    return _points(spark, sf_dir).select("city_bfs_id", "id", "time", _m(mx, "mx"), _m(my, "my"))


# Aggregates

def provider_stats(spark, sf_dir):
    rows = stats.provider_stats(observations.scan_status(ev.observations(spark, sf_dir), ev.JANUARY))
    return rows.withColumn("avg_delta_updated", F.round("avg_delta_updated", 6))


def vehicle_registry(spark, sf_dir):
    return stats.registry(observations.scan_sightings(ev.observations(spark, sf_dir), ev.JANUARY))


def vehicle_list(spark, sf_dir):
    return stats.vehicles(_datapoints(spark, sf_dir), "time_airflow")


# Stays and history

def step_distance(spark, sf_dir):
    rows = stays.steps(stays.with_lv03(stays.distinct_observations(_points(spark, sf_dir))))
    return rows.select("city_bfs_id", "id", "time", _m("distance_m"))


def _stay_rows(df: DataFrame) -> DataFrame:
    return df.select("city_bfs_id", "id", "provider", "time_from", "time_to", _m("distance_m"), "moving",
                     _m("x"), _m("y"), _deg("lon"), _deg("lat"))


def stay_segments(spark, sf_dir):
    return _stay_rows(_stays(spark, sf_dir))


def history_top2(spark, sf_dir):
    recent = paths.recent_stays(_path(spark, sf_dir), ev.MID_JANUARY.start)
    return recent.select("id", "provider", "time", "r", _deg("lon"), _deg("lat"))


def stays_incremental(spark, sf_dir):
    history = paths.recent_stays(_path(spark, sf_dir, FIRST_PART), ev.MID_JANUARY.start)
    points = paths.stitch(_points(spark, sf_dir, ev.MID_JANUARY), history, ev.MID_JANUARY.start)
    found = stays.segment(points, active_after=ev.MID_JANUARY.start)
    return _stay_rows(found.where(F.col("time_to") >= ts(ev.MID_JANUARY.start)))


# Streets and routes

def street_clip(spark, sf_dir):
    """Edges of the stored, untidy graph once clipped, with how many vehicle positions start nearest to them."""
    at = [scratch_path(spark, name) for name in ("street-nodes", "street-edges")]
    ev.untidy_street_nodes(spark).write.parquet(at[0])
    ev.untidy_street_edges(spark).write.parquet(at[1])
    nodes = streets.clip_nodes(streets.read_street_nodes(spark, at[0]))
    edges = streets.lightest_edges(streets.clip_edges(streets.read_street_edges(spark, at[1]), nodes))
    near = paths.nearest_nodes(_stays(spark, sf_dir), nodes, (*stays.VEHICLE, "stay"))
    snapped = near.select("city_bfs_id", F.inline(F.array(*[
        F.struct(F.lit(m).alias("mode"), F.col(f"node_{m}").alias("u")) for m in streets.MODES])))
    used = snapped.groupBy("city_bfs_id", "mode", "u").agg(F.count(F.lit(1)).alias("stays"))
    return (edges.join(used, ["city_bfs_id", "mode", "u"], "left")
            .select("city_bfs_id", "mode", "u", "v", _m("length_m"), F.coalesce("stays", F.lit(0)).cast("bigint").alias("stays")))


def nearest_node(spark, sf_dir):
    near = paths.nearest_nodes(_stays(spark, sf_dir), ev.street_nodes(spark), (*stays.VEHICLE, "stay"))
    return near.select("city_bfs_id", "id", "time_from", "node_walk", "node_bike",
                       _m("node_walk_m"), _m("node_bike_m"))


def _snapped(spark, sf_dir):
    return stage(paths.snapped_stays(_stays(spark, sf_dir), ev.street_nodes(spark)), "snapped")


def shortest_path(spark, sf_dir):
    pairs = routing.pairs_from(_snapped(spark, sf_dir), streets.MODES)
    return routing.shortest_lengths(pairs, ev.street_edges(spark)).select(
        "city_bfs_id", "mode", "origin", "destination", _m("length_m"))


def path_table(spark, sf_dir):
    rows = paths.build_paths(_points(spark, sf_dir), ev.street_nodes(spark), ev.street_edges(spark), ev.JANUARY)
    return rows.select(
        "id", "provider", "city_bfs_id", _deg("point.x", "lon"), _deg("point.y", "lat"), "time_from", "time_to",
        _m("distance_m"), "moving", _m("distance_m_walk"), _m("distance_m_bike"),
        F.size("path_walk_since_last").alias("walk_vertices"), F.size("path_bike_since_last").alias("bike_vertices"))


# Marts

def path_vertices(spark, sf_dir):
    return marts.path_vertices(_path(spark, sf_dir)).select(
        "id", "time_from", "path_idx", _deg("vertex.x", "lon"), _deg("vertex.y", "lat"))


def path_length(spark, sf_dir):
    return _path(spark, sf_dir).select("id", "time_from", "time_to", _m("distance_m_walk"), _m(
        geo.line_length(F.col("path_walk_since_last")), "line_m"))


def mart_edges(spark, sf_dir):
    return marts.edges(_path(spark, sf_dir), ev.JANUARY).select(
        "id", "provider", "city_bfs_id", "time_from", "time_to", "path_idx",
        _deg("point.x", "lon"), _deg("point.y", "lat"),
        _deg("point_before.x", "lon_before"), _deg("point_before.y", "lat_before"), _m("distance_m"))


def mart_distinct_ids(spark, sf_dir):
    return marts.distinct_vehicles(_path(spark, sf_dir))


def mart_distinct_ids_day(spark, sf_dir):
    """One calendar day, as the daily job writes it."""
    return marts.distinct_vehicles(_path(spark, sf_dir), ev.MID_JANUARY.start)


def mart_vehicle_age(spark, sf_dir):
    return marts.vehicle_age(_path(spark, sf_dir), ev.JANUARY).withColumn(
        "avg_age_days_scooter", F.round("avg_age_days_scooter", 6))


def trip_numbers(spark, sf_dir):
    return marts.trip_numbers(_path(spark, sf_dir), ev.MID_JANUARY).select("id", "time_from", "moving", "trip_id")


def mart_trip_distance(spark, sf_dir):
    trips = marts.one_row_per_trip(marts.trip_distance(_path(spark, sf_dir), ev.MID_JANUARY))
    return trips.withColumns({c: F.round(c, 3) for c in ("trip_walk_distance_m", "trip_bike_distance_m")})


# Table maintenance and quality

def upsert_replace(spark, sf_dir):
    def rows(part):
        return _stays(spark, sf_dir, part).select("id", "provider", "city_bfs_id", "time_from", "time_to", "distance_m")
    merged = merge.replace(paths.one_region_per_key(rows(EARLY)), paths.one_region_per_key(rows(LATE)),
                           ("id", "time_from"))
    return merged.withColumn("distance_m", F.round("distance_m", 3))


def upsert_accumulate(spark, sf_dir):
    def rows(part):
        return stats.one_row_per_vehicle(stats.registry(
            observations.scan_sightings(ev.observations(spark, sf_dir), part)))
    return merge.accumulate(rows(EARLY), rows(LATE))


def retention_keep(spark, sf_dir):
    kept = merge.retain(_path(spark, sf_dir), "time_from", "2024-01-15", 230)
    return kept.select("id", "city_bfs_id", "time_from", "time_to")


def rows_in_interval(spark, sf_dir):
    return quality.rows_in_interval(_path(spark, sf_dir), ev.MID_JANUARY)


def not_null_report(spark, sf_dir):
    return quality.not_null_report(_datapoints(spark, sf_dir),
                                   ("id", "provider", "time_provider", "lon", "is_disabled", "is_reserved"))


# Collection and streams

def collect_enrich(spark, sf_dir):
    pages = ev.observations(spark, sf_dir).select("id", "geometry", "properties")
    rows = enrich(pages, ev.provider_feed(spark, sf_dir), ts(RUN_TIME))
    return rows.select("id", F.col("properties.id").alias("vehicle"), F.col("properties.provider.id").alias("provider"),
                       F.to_json("properties.provider").alias("provider_document"),
                       _deg(F.col("geometry.coordinates")[0], "lon"), _deg(F.col("geometry.coordinates")[1], "lat"),
                       F.col("_meta_runtime_utc").alias("runtime"), F.col("_meta_last_updated_utc").alias("refreshed"))


def offering_providers(spark, sf_dir):
    return feeds.offering(ev.provider_feed(spark, sf_dir)).select("provider_id", "last_updated")


def stream_provider_stats(spark, sf_dir):
    """Every bin, streamed into the table of statistics."""
    store = Warehouse(spark, scratch_path(spark, "stream-store"))
    streams.provider_stats(ev.observations(spark, sf_dir, streaming=True), lambda s: ev.observations(s, sf_dir), store,
                           scratch_path(spark, "stream-state"), available_now=True).awaitTermination()
    return store.read(schema.PROVIDER_STATS).withColumn("avg_delta_updated", F.round("avg_delta_updated", 6))


def stream_registry(spark, sf_dir):
    """Every vehicle, streamed into the registry."""
    store = Warehouse(spark, scratch_path(spark, "registry-store"))
    streams.registry(ev.observations(spark, sf_dir, streaming=True), store,
                     scratch_path(spark, "registry-state"), available_now=True).awaitTermination()
    return store.read(schema.IDS)


def stream_settled_counts(spark, sf_dir):
    """Bins that ended ten minutes before the newest row, streamed to an append-only table; every row is sent twice."""
    sink, seen = scratch_path(spark, "settled-bins"), ev.observations(spark, sf_dir, streaming=True)
    twice = seen.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("again")
    streams.settled_counts(twice, sink, scratch_path(spark, "settled-state"), available_now=True).awaitTermination()
    return spark.read.schema("time timestamp, provider string, city_bfs_id int, count_datapoints long").parquet(sink)


def registry_rerun(spark, sf_dir):
    """Two overlapping intervals added to the stored registry, the first one twice, the second between."""
    store = Warehouse(spark, scratch_path(spark, "rerun-store"))
    for name, part in (("early", EARLY), ("late", LATE), ("early", EARLY)):
        rows = stats.registry(observations.scan_sightings(ev.observations(spark, sf_dir), part))
        store.contribute(schema.IDS, stats.one_row_per_vehicle(rows), name)
    return store.read(schema.IDS)


def _landed_pages(spark, sf_dir):
    """The observations as landed page files; every seventh document has a word for a flag."""
    rows = ev.observations(spark, sf_dir).select("id", "geometry", "properties", "_meta_runtime_utc")
    odd = F.pmod(F.unix_seconds("_meta_runtime_utc"), F.lit(7)) == 0
    text = F.to_json(F.struct("id", "geometry", "properties"))
    text = F.when(odd, F.regexp_replace(text, '"available":true', '"available":"yes"')).otherwise(text)
    return stored.land(rows, text, "pages")


def pages_scan(spark, sf_dir):
    """All documents of landed pages; a flag that is no flag is null and costs nothing else."""
    rows = feeds.read_pages(spark, _landed_pages(spark, sf_dir))
    return rows.select("id", F.col("properties.id").alias("vehicle"), F.col("properties.provider.id").alias("provider"),
                       _deg(F.col("geometry.coordinates")[0], "lon"), _deg(F.col("geometry.coordinates")[1], "lat"),
                       F.col("properties.available").alias("available"))


# Exploration

def explore_scan(spark, sf_dir):
    rows = observations.explore(ev.observations(spark, sf_dir), lat=(46.0, 47.5), lon=(7.0, 8.75),
                                timerange=("2024-01-05", "2024-01-25"))
    return rows.select("time_provider", "time_airflow", "id", _deg("lon"), _deg("lat"), "provider",
                       "is_available", "is_disabled", "is_reserved")


def distance_from_last_row(spark, sf_dir):
    rows = explore.distance_from_last_row(_datapoints(spark, sf_dir))
    return rows.select("id", "time_airflow", _m("distance_m"))


def moved_datapoints(spark, sf_dir):
    rows = explore.moved_datapoints(_datapoints(spark, sf_dir))
    return rows.select("id", "time_airflow", "time_provider", _m("distance_m"), "time_from", "time_to",
                       _m("stay_in_pos_sec"))


def distance_from_point(spark, sf_dir):
    rows = explore.distance_from_point(_datapoints(spark, sf_dir), *PLACE)
    return rows.select("id", "time_airflow", _m("distance_m"))


def tz_convert(spark, sf_dir):
    return explore.convert_time_zone(_datapoints(spark, sf_dir), ["time_provider", "time_airflow"]).select(
        "id", "time_provider", "time_airflow", F.date_trunc("hour", F.col("time_airflow")).cast("timestamp_ntz").alias("hour"))


QUERIES: tuple[Query, ...] = (
    provider_stats, vehicle_registry, vehicle_list, observation_scan, region_counts, observation_dedup,
    reproject_lv03, reproject_mercator, step_distance, stay_segments, history_top2, stays_incremental,
    street_clip, nearest_node, shortest_path, path_table, path_vertices, path_length, mart_edges,
    mart_distinct_ids, mart_distinct_ids_day, mart_vehicle_age, trip_numbers, mart_trip_distance, upsert_replace, upsert_accumulate,
    retention_keep, rows_in_interval, not_null_report, collect_enrich, offering_providers,
    stream_provider_stats, stream_registry, stream_settled_counts, registry_rerun, pages_scan, explore_scan, distance_from_last_row, moved_datapoints, distance_from_point, tz_convert,
    *stored.QUERIES,
)


def catalog() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: _plain(query(spark, sf_dir))
    return {q.__name__: wrap(q) for q in QUERIES}
