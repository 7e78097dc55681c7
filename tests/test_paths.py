"""Tracks to path rows, as the daily job does it."""

import datetime as dt

import pytest
from conftest import STANDING, TRACK, documents

from curbline.functions.timing import Interval
from curbline.operators.paths import build_paths, recent_stays, stitch
from curbline.operators.stays import segment
from curbline.schema import PATH
from curbline.sources.observations import scan_points

DAY = Interval.of("2023-01-01 00:05:00", "2023-01-02 00:05:00")
SINGLE = documents(TRACK)
DOUBLE = SINGLE + documents(TRACK, "Voi", "voi:1")
STILL = documents([(time, *TRACK[i % 3][1:]) for i, time in enumerate(STANDING)])


@pytest.fixture
def build(json_documents, streets):
    return lambda rows: build_paths(scan_points(json_documents(rows)), *streets, DAY).orderBy("id", "time_from").collect()


def test_single_vehicle(build):
    rows = build(SINGLE)
    assert [r.moving for r in rows] == [True, False, False]
    assert {r.provider for r in rows} == {"Bolt"}
    assert min(r.time_from for r in rows) == dt.datetime(2023, 1, 1, 1, 41, 15)
    assert max(r.time_to for r in rows) == dt.datetime(2023, 1, 1, 2, 40, 15)
    assert [round(r.distance_m, 2) for r in rows] == [559.63, 550.62, 363.55]
    for row, (low, high) in zip(rows, ((500, 600), (500, 600), (300, 400))):
        assert low <= row.distance_m <= high
        for routed in (row.distance_m_walk, row.distance_m_bike):
            assert low / 1.8 <= routed <= high * 1.8
        assert len(row.path_walk_since_last) >= 2 and len(row.path_bike_since_last) >= 2


def test_two_vehicles(build):
    rows = build(DOUBLE)
    assert len(rows) == 6
    assert {p: sum(r.provider == p for r in rows) for p in ("Bolt", "Voi")} == {"Bolt": 3, "Voi": 3}
    assert sum(r.moving for r in rows) == 2


def test_standing_still(build):
    assert build(STILL) == []


def test_stays_of_the_track(spark, json_documents):
    stays = segment(scan_points(json_documents(SINGLE))).orderBy("stay").collect()
    assert [(round(s.x, 2), round(s.y, 2)) for s in stays] == [
        (695538.39, 260803.32), (695929.32, 261213.08), (696330.02, 261574.50), (696674.78, 261658.69)]
    assert [s.moving for s in stays] == [False, True, False, False]
    assert stays[0].distance_m == 0.0


@pytest.mark.parametrize("seconds", [1, 120, 600, 86400 * 400])
def test_slices_do_not_change_stays(json_documents, seconds):
    points = scan_points(json_documents(DOUBLE + STILL))
    columns = ["id", "stay", "provider", "time_from", "time_to", "moving"]
    expected = segment(points).orderBy("id", "stay")
    got = segment(points, slice_seconds=seconds).orderBy("id", "stay")
    assert got.select(columns).collect() == expected.select(columns).collect()
    for a, b in zip(got.collect(), expected.collect()):
        assert a.distance_m == pytest.approx(b.distance_m) and a.x == pytest.approx(b.x) and a.y == pytest.approx(b.y)


def point_rows(spark, rows):
    """(id, time, lon, lat[, provider]) in Winterthur."""
    import pyspark.sql.functions as F
    return spark.createDataFrame(
        [(230, r[0], r[4] if len(r) > 4 else "Bolt", r[1], r[1], r[2], r[3]) for r in rows],
        "city_bfs_id int, id string, provider string, time string, runtime string, lon double, lat double").withColumns(
        {"time": F.col("time").cast("timestamp"), "runtime": F.col("runtime").cast("timestamp")})


def test_repeated_time_keeps_one_row_and_threshold_is_strict(spark):
    rows = [("a", "2023-01-01 10:00:00", 8.70, 47.49), ("a", "2023-01-01 10:00:00", 8.75, 47.49),
            ("a", "2023-01-01 10:02:00", 8.70, 47.4901)]
    points = point_rows(spark, rows)
    step = 11.119
    assert segment(points).count() == 1
    exact = segment(points, threshold_m=0.0).orderBy("stay").collect()
    assert len(exact) == 2 and exact[1].distance_m == pytest.approx(step, rel=1e-3)
    assert segment(points, threshold_m=exact[1].distance_m).count() == 1


def history_rows(spark, rows):
    """(id, time_from, time_to, lon, lat) as path rows."""
    import pyspark.sql.functions as F
    line = "array(named_struct('x', lon, 'y', lat), named_struct('x', lon, 'y', lat))"
    df = spark.createDataFrame(rows, "id string, time_from string, time_to string, lon double, lat double")
    return df.select(
        "id", F.lit("Bolt").alias("provider"), F.lit(230).alias("city_bfs_id"),
        F.expr("named_struct('x', lon, 'y', lat)").alias("point"), F.col("time_from").cast("timestamp"),
        F.col("time_to").cast("timestamp"), F.lit(0.0).alias("distance_m"), F.lit(False).alias("moving"),
        F.lit(1.0).alias("distance_m_walk"), F.expr(line).alias("path_walk_since_last"),
        F.lit(1.0).alias("distance_m_bike"), F.expr(line).alias("path_bike_since_last")).select(PATH.columns)


def test_history_keeps_two_rows_within_thirty_days(spark):
    stored = history_rows(spark, [
        ("a", "2022-12-02 00:00:00", "2022-12-02 00:05:00", 8.70, 47.49),
        ("a", "2022-12-20 00:00:00", "2022-12-21 00:00:00", 8.71, 47.49),
        ("a", "2022-12-30 00:00:00", "2023-01-01 00:05:00", 8.72, 47.49),
        ("b", "2022-12-02 00:00:00", "2022-12-02 00:05:00", 8.70, 47.49),
        ("c", "2022-12-01 00:00:00", "2022-12-02 00:04:59", 8.70, 47.49),
        ("c", "2023-01-01 00:00:00", "2023-01-01 00:05:01", 8.70, 47.49)])
    got = {(r.id, r.time.day) for r in recent_stays(stored, DAY.start).collect()}
    assert got == {("a", 20), ("a", 30), ("b", 2)}


def test_a_continuing_stay_is_extended_under_its_key(spark):
    stored = history_rows(spark, [("a", "2022-12-31 20:00:00", "2022-12-31 23:00:00", 8.70, 47.49),
                                  ("gone", "2022-12-31 20:00:00", "2022-12-31 23:00:00", 8.70, 47.49)])
    new = point_rows(spark, [("a", "2023-01-01 08:00:00", 8.7001, 47.49), ("a", "2023-01-01 09:00:00", 8.72, 47.49)])
    points = stitch(new, recent_stays(stored, DAY.start), DAY.start)
    stays = segment(points, active_after=DAY.start).orderBy("stay").collect()
    assert [s.id for s in stays] == ["a", "a"]
    assert stays[0].time_from == dt.datetime(2022, 12, 31, 20) and stays[0].time_to == dt.datetime(2023, 1, 1, 8)
    assert stays[1].distance_m == pytest.approx(1500, rel=0.02)


def test_stale_vehicles_are_left_out(spark):
    new = point_rows(spark, [("old", "2022-12-31 08:00:00", 8.70, 47.49), ("a", "2023-01-01 09:00:00", 8.72, 47.49)])
    assert [s.id for s in segment(new, active_after=DAY.start).collect()] == ["a"]


def test_one_vehicle_with_most_rows(spark):
    """A vehicle that moves at every tick, next to quiet ones, against a plain window."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    from curbline.operators.stays import with_lv03
    from curbline.functions.geo import planar_distance
    ticks = spark.range(4000).select(
        F.lit(230).alias("city_bfs_id"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("q"), F.col("id") % 50)).otherwise("hot").alias("id"),
        F.lit("Bolt").alias("provider"), F.timestamp_seconds(F.col("id") * 77 + 1672531200).alias("time"),
        F.timestamp_seconds(F.col("id") * 77 + 1672531200).alias("runtime"),
        (8.70 + 0.001 * ((F.col("id") * 31) % 17 % 3)).alias("lon"), F.lit(47.49).alias("lat"))
    w = W.partitionBy("id").orderBy("time")
    walked = with_lv03(ticks).withColumns({"px": F.lag("x").over(w), "py": F.lag("y").over(w)})
    flagged = walked.withColumn("m", F.coalesce(
        planar_distance(F.col("px"), F.col("py"), F.col("x"), F.col("y")) > 50, F.lit(False)).cast("int"))
    expected = (flagged.withColumn("stay", F.sum("m").over(w.rowsBetween(W.unboundedPreceding, 0)))
                .groupBy("id", "stay").agg(F.min("time").alias("time_from"), F.max("time").alias("time_to")))
    got = segment(ticks, slice_seconds=3600).select("id", "stay", "time_from", "time_to")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_node_is_found_at_any_distance(spark):
    """A stay of another region's vehicle, over 150 km away, and one without coordinates."""
    from curbline.functions.geo import lv03
    from curbline.operators.nearest import nearest_nodes
    from pyspark.sql import functions as F

    nodes = spark.createDataFrame(
        [(3203, m, n, 9.37 + n / 1000, 47.42) for m in ("walk", "bike") for n in (1, 2)]
        + [(351, "walk", 7, 7.44, 46.95), (230, "walk", 8, 40.0, 20.0)],
        "city_bfs_id int, mode string, node_id bigint, lon double, lat double")
    points = spark.createDataFrame(
        [("far", 3203, 7.4402, 46.9501), ("near", 3203, 9.3712, 47.42), ("own", 351, 7.4402, 46.9501),
         ("nowhere", 3203, None, None), ("off", 230, 8.7, 47.4)], "id string, city_bfs_id int, lon double, lat double")
    x, y = lv03(F.col("lon"), F.col("lat"))
    got = {r.id: (r.node_walk, r.node_bike) for r in
           nearest_nodes(points.withColumns({"x": x, "y": y}), nodes, ("id", "city_bfs_id")).collect()}
    assert got == {"far": (1, 1), "near": (1, 1), "own": (7, None), "nowhere": (None, None), "off": (None, None)}
