"""Marts and statistics on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curbline.functions.timing import Interval
from curbline.operators import marts, stats
from curbline.schema import OBSERVATION_DDL, PATH
from curbline.sources.observations import scan_points, scan_sightings, scan_status

DAY = Interval.of("2023-01-10", "2023-01-11")


def at(hour, minute=0, day=10):
    return dt.datetime(2023, 1, day, hour, minute)


def path_rows(spark, rows):
    """(id, time_from, time_to, moving, walking vertices or None[, provider, region])"""
    full = []
    for id_, start, stop, moving, line, *rest in rows:
        provider, region = (rest + ["Bolt", 230][len(rest):])
        vertices = None if line is None else [{"x": 8.70 + v * 0.001, "y": 47.49} for v in line]
        full.append((id_, provider, region, {"x": 8.7, "y": 47.49}, start, stop, 10.0, moving, 100.0, vertices, 200.0, vertices))
    return spark.createDataFrame(full, PATH.ddl)


def test_edges(spark):
    rows = [("a", at(1), at(2), False, [0, 1, 2]), ("a", at(3), at(4), False, [2, 5]),
            ("a", at(5), at(6), False, None), ("b", at(1), at(2), False, [7, 8]),
            ("a", at(0, day=9), at(1, day=9), False, [9, 9])]
    got = sorted((r.id, r.time_from.hour, r.path_idx, round((r.point.x - 8.7) * 1000),
                  None if r.point_before is None else round((r.point_before.x - 8.7) * 1000))
                 for r in marts.edges(path_rows(spark, rows), DAY).collect())
    assert got == [("a", 1, 1, 0, None), ("a", 1, 2, 1, 0), ("a", 1, 3, 2, 1), ("a", 3, 1, 2, 2), ("a", 3, 2, 5, 2),
                   ("b", 1, 1, 7, None), ("b", 1, 2, 8, 7)]
    metres = {(r.id, r.path_idx): r.distance_m for r in marts.edges(path_rows(spark, rows[3:4]), DAY).collect()}
    assert metres["b", 1] is None and metres["b", 2] == pytest.approx(111.319, abs=0.01)


def test_edges_of_paths_ending_together_interleave_by_vertex(spark):
    rows = [("a", at(1), at(4), False, [0, 1]), ("a", at(3), at(4), False, [5, 6])]
    for seconds in (60, 21600):
        got = {(r.time_from.hour, r.path_idx): None if r.point_before is None else round((r.point_before.x - 8.7) * 1000)
               for r in marts.edges(path_rows(spark, rows), DAY, seconds).collect()}
        assert got == {(1, 1): None, (3, 1): 0, (1, 2): 5, (3, 2): 1}


def test_distinct_vehicles_takes_the_whole_day(spark):
    rows = [("a", at(0), at(1), False, None), ("a", at(23), at(23, 30), False, None), ("b", at(5), at(6), False, None),
            ("b", at(5, day=11), at(6, day=11), False, None)]
    got = marts.distinct_vehicles(path_rows(spark, rows), "2023-01-10 13:00:00").collect()
    assert [(r.time, r.distinct_ids) for r in got] == [(at(0), 2)]


def test_vehicle_age(spark):
    rows = [("short", at(1, 30), at(2, 20), False, None),
            ("a", at(1, 30), at(2), False, None), ("a", at(2), at(4, 40), False, None),
            ("b", at(3), at(5), False, None)]
    got = {r.time.hour: r.avg_age_days_scooter * 24 for r in marts.vehicle_age(path_rows(spark, rows), DAY).collect()}
    assert got.keys() == {2, 3, 4, 5}
    assert got[2] == pytest.approx(0.5) and got[3] == pytest.approx(1.5)
    assert got[4] == pytest.approx((2.5 + 1) / 2) and got[5] == pytest.approx(2)
    clipped = marts.vehicle_age(path_rows(spark, rows), Interval.of("2023-01-10 03:00:00", "2023-01-10 04:30:00"))
    assert {r.time.hour for r in clipped.collect()} == {3, 4}


def test_trips(spark):
    rows = [("a", at(1, day=9), at(2, day=9), False, None), ("a", at(1), at(1), True, None),
            ("a", at(2), at(3), False, None), ("a", at(4), at(4), True, None), ("a", at(5), at(5), True, None),
            ("a", at(6), at(7), False, None, "Voi"), ("b", at(1), at(1), True, None), ("b", at(8), at(9), False, None)]
    for seconds in (60, 21600):
        numbers = {(r.id, r.time_from.hour): r.trip_id for r in marts.trip_numbers(path_rows(spark, rows), DAY, seconds).collect()}
        assert numbers == {("a", 1): 1, ("a", 2): 2, ("a", 4): 2, ("a", 5): 2, ("a", 6): 3, ("b", 1): 0, ("b", 8): 1}
    trips = {(r.id, r.trip_id): (r.trip_start.hour, r.trip_end.hour, r.trip_walk_distance_m, r.trip_bike_distance_m)
             for r in marts.trip_distance(path_rows(spark, rows), DAY).collect()}
    assert trips["a", "2"] == (2, 5, 300.0, 600.0) and trips["b", "0"] == (1, 1, 100.0, 200.0)


def test_trip_that_changes_provider_folds_to_its_key(spark):
    rows = [("a", at(1), at(2), False, None, "Bolt"), ("a", at(3), at(3), True, None, "Voi", 296)]
    trips = marts.trip_distance(path_rows(spark, rows), DAY)
    assert trips.count() == 2
    assert [(r.provider, r.city_bfs_id, r.trip_start.hour, r.trip_end.hour, r.trip_walk_distance_m)
            for r in marts.one_row_per_trip(trips).collect()] == [("Voi", 296, 1, 3, 200.0)]


def observations(spark, rows):
    """(id, inner id, run time, refresh time, lon, lat, status or None)"""
    return spark.createDataFrame([
        (i, {"coordinates": [lon, lat]},
         {"id": inner, "available": True, "provider": {"id": "bolt", "name": "Bolt", "apps": None},
          "vehicle": None if status is None else {"status": {"disabled": status[0], "reserved": status[1]}}},
         run, refresh) for i, inner, run, refresh, lon, lat, status in rows], OBSERVATION_DDL)


def test_provider_stats_and_registry(spark):
    rows = [("t1", "v1", at(0, 1), at(0, 0), 8.70, 47.49, (True, False)),
            ("t2", "v1", at(0, 1), at(0, 0), 8.70, 47.49, None),
            ("t3", "v2", at(0, 3), at(0, 0), 8.70, 47.49, (None, True)),
            ("on the start", "v3", at(0, 0), at(0, 0), 8.70, 47.49, None),
            ("on the end", "v3", at(0, 0, 11), at(0, 0), 8.70, 47.49, None),
            ("on the edge", "v4", at(0, 1), at(0, 0), 8.687158, 47.49, None)]
    obs = observations(spark, rows)
    got = [tuple(r) for r in stats.provider_stats(scan_status(obs, DAY)).orderBy("time").collect()]
    assert got == [(at(0, 0), "Bolt", 230, 2, 1, 60.0, 2, 1, 0), (at(0, 2), "Bolt", 230, 1, 1, 180.0, 1, 0, 1)]
    ids = {r.id: (r.first_seen, r.last_seen, r.datapoints) for r in stats.registry(scan_sightings(obs, DAY)).collect()}
    assert ids == {"v1": (at(0), at(0), 1), "v2": (at(0), at(0), 1)}
    assert {r.id for r in scan_points(obs, DAY).collect()} == {"t1", "t2", "t3"}


def test_overlapping_regions_give_one_row_each(spark):
    obs = observations(spark, [("t", "v", at(1), at(1), 8.70, 47.4503, None)])
    assert sorted(r.city_bfs_id for r in scan_points(obs, DAY).collect()) == [230, 296]


def test_scan_reads_only_needed_leaves(spark, tmp_path):
    from curbline.sources.observations import read_observations
    from curbline.sources.warehouse import append_observations
    append_observations(observations(spark, [("t", "v", at(1), at(1), 8.70, 47.49, None),
                                             ("u", "w", at(1, day=20), at(1), 8.70, 47.49, None)]), str(tmp_path / "obs"))
    points = scan_points(read_observations(spark, str(tmp_path / "obs")), DAY)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "vehicle" not in plan and "PartitionFilters: [isnotnull(date" in plan
    assert "GreaterThan(lat" in plan and "GreaterThan(_meta_runtime_utc" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert [r.id for r in points.collect()] == ["t"]
