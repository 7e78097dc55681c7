"""Declared schemas, keys and partitioning of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

POINT = "struct<x: double, y: double>"
LINE = f"array<{POINT}>"

OBSERVATION_DDL = (
    "id string, geometry struct<coordinates: array<double>>, "
    "properties struct<id: string, available: boolean, provider: struct<id: string, name: string, apps: string>, "
    "vehicle: struct<status: struct<disabled: boolean, reserved: boolean>>>, "
    "_meta_runtime_utc timestamp, _meta_last_updated_utc timestamp"
)
# A landed page row has no metadata yet.
PAGE_DDL = (
    "id string, geometry struct<coordinates: array<double>>, "
    "properties struct<id: string, available: boolean, provider: struct<id: string, name: string, apps: string>, "
    "vehicle: struct<status: struct<disabled: boolean, reserved: boolean>>>"
)
PROVIDER_FEED_DDL = "provider_id string, vehicle_type array<string>, last_updated bigint"


@dataclass(frozen=True)
class Table:
    """``partition`` is (column, expression): derived from the row, so upserts find it again.

    An upsert replaces all rows that share the columns ``replaces`` with an update, the key by
    default. A table partitioned by ``part`` keeps what every run contributed; its rows are
    those contributions added up.
    """

    name: str
    ddl: str
    key: tuple[str, ...]
    partition: tuple[str, str]
    replaces: tuple[str, ...] = ()

    @property
    def in_parts(self) -> bool:
        return self.partition[0] == "part"

    @property
    def columns(self) -> list[str]:
        return StructType.fromDDL(self.ddl).fieldNames()


PATH = Table(
    "path",
    f"id string, provider string, city_bfs_id int, point {POINT}, time_from timestamp, time_to timestamp, "
    f"distance_m double, moving boolean, distance_m_walk double, path_walk_since_last {LINE}, "
    f"distance_m_bike double, path_bike_since_last {LINE}",
    ("id", "time_from"), ("day", "to_date(time_from)"))
PROVIDER_STATS = Table(
    "provider_stats",
    "time timestamp, provider string, city_bfs_id int, count_datapoints bigint, count_distinct_ids bigint, "
    "avg_delta_updated double, count_available bigint, count_disabled bigint, count_reserved bigint",
    ("time", "provider", "city_bfs_id"), ("day", "to_date(time)"))
IDS = Table(
    "ids",
    "id string, provider string, city_bfs_id int, first_seen timestamp, last_seen timestamp, datapoints bigint",
    ("id", "city_bfs_id"), ("part", "part"))
MART_EDGES = Table(
    "mart_edges",
    f"id string, provider string, city_bfs_id int, time_from timestamp, time_to timestamp, path_idx int, "
    f"point {POINT}, point_before {POINT}, distance_m double",
    ("id", "time_from", "path_idx"), ("day", "to_date(time_from)"), ("id", "time_from"))
MART_DISTINCT_IDS = Table(
    "mart_distinct_ids",
    "provider string, city_bfs_id int, time timestamp, distinct_ids bigint",
    ("provider", "city_bfs_id", "time"), ("day", "to_date(time)"))
MART_VEHICLE_AGE = Table(
    "mart_scooter_age",
    "time timestamp, city_bfs_id int, provider string, avg_age_days_scooter double",
    ("time", "city_bfs_id", "provider"), ("day", "to_date(time)"))
# A trip's region and start may change on conflict, so only its vehicle id can place it.
MART_TRIP_DISTANCE = Table(
    "mart_trip_distance",
    "id string, provider string, city_bfs_id int, trip_id string, trip_start timestamp, trip_end timestamp, "
    "trip_walk_distance_m double, trip_bike_distance_m double",
    ("id", "trip_id"), ("bucket", "pmod(xxhash64(id), 64)"))

TABLES: tuple[Table, ...] = (
    PATH, PROVIDER_STATS, IDS, MART_EDGES, MART_DISTINCT_IDS, MART_VEHICLE_AGE, MART_TRIP_DISTANCE)
