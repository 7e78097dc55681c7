"""Exploration helpers."""

import datetime as dt

import pytest
from pyspark.sql import Row
from test_marts import at, observations

from curbline.functions.geo import line_length, lv03, wgs84, with_lv03_anywhere
from curbline.operators import explore
from curbline.operators.stats import vehicles
from curbline.sources.observations import explore as scan
from pyspark.sql import functions as F

NO = (False, False)


@pytest.fixture
def points(spark):
    """One vehicle that moves 0, 15, 30, 0 and 45 metres or so, and one seen once."""
    lons = [8.7000, 8.7002, 8.7006, 8.7006, 8.7012]
    return scan(observations(spark, [("a", "v", at(1, 2 * i), at(1, 2 * i - 1 if i else 0), lon, 47.49, NO)
                                     for i, lon in enumerate(lons)] + [("b", "w", at(1), at(1), 8.70, 47.49, NO)]))


@pytest.mark.parametrize("seconds", [60, 21600])
def test_moved_datapoints(points, seconds):
    rows = explore.moved_datapoints(points, slice_seconds=seconds).orderBy("id", "time_airflow").collect()
    assert [(r.id, r.time_airflow.minute, r.time_from.minute, r.time_to.minute, r.stay_in_pos_sec) for r in rows] == [
        ("a", 0, 0, 1, 60.0), ("a", 4, 3, 5, 120.0), ("a", 8, 7, 7, 0.0), ("b", 0, 0, 0, 0.0)]
    assert "_rank" not in rows[0].asDict()
    assert "_rank" in explore.moved_datapoints(points, debug=True).columns
    every = explore.moved_datapoints(points, 0.0, slice_seconds=seconds).orderBy("id", "time_airflow").collect()
    assert [(r.id, r.time_airflow.minute) for r in every] == [("a", 0), ("a", 2), ("a", 4), ("a", 6), ("a", 8), ("b", 0)]
    assert [(r.time_from.minute, r.time_to.minute) for r in every[2:4]] == [(3, 5), (3, 5)]


def test_distances(points):
    steps = [r.distance_m for r in explore.distance_from_last_row(points).where("id = 'a'").orderBy("time_airflow").collect()]
    assert steps[0] is None and steps[1] == pytest.approx(15.06, abs=0.1) and steps[3] == 0.0
    x, y = lv03(F.lit(8.7), F.lit(47.49))
    here = points.select(x.alias("x"), y.alias("y")).first()
    far = explore.distance_from_point(points, here.x, here.y + 100).where("id = 'b'").first()
    assert far.distance_m == pytest.approx(100)


def test_filters(spark, points):
    obs = observations(spark, [("a", "v", at(1), at(1), 8.70, 47.49, NO), ("b", "w", at(2), at(2), 8.71, 47.50, NO)])
    assert scan(obs).count() == 2
    assert [r.id for r in scan(obs, lat=(47.49, 47.6)).collect()] == ["b"]
    assert [r.id for r in scan(obs, lon=(8.0, 8.71)).collect()] == ["a"]
    assert [r.id for r in scan(obs, timerange=(at(1), at(3))).collect()] == ["b"]
    assert [r.id for r in scan(obs, ids=["b", "c"]).collect()] == ["b"]
    assert [r.id for r in scan(obs, ids=spark.createDataFrame([Row(id="b")])).collect()] == ["b"]
    assert scan(obs, lat=(47.49, 47.6), ids=["a"]).count() == 0
    with pytest.raises(Exception, match="document without properties.vehicle.status"):
        scan(observations(spark, [("a", "v", at(1), at(1), 8.70, 47.49, None)])).collect()
    assert {r.id: r.provider for r in vehicles(points, "time_airflow").collect()} == {"a": "bolt", "b": "bolt"}


def test_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 23, 30), dt.datetime(2023, 7, 1, 23, 30))], "a timestamp, b timestamp")
    row = explore.convert_time_zone(df, ["a", "b"]).first()
    assert row.a == dt.datetime(2023, 1, 2, 0, 30) and row.b == dt.datetime(2023, 7, 2, 1, 30)


def test_projections_round_trip(spark):
    df = spark.createDataFrame([(8.7, 47.49), (7.45, 46.95), (2.0, 47.0)], "lon double, lat double")
    x, y = lv03(F.col("lon"), F.col("lat"))
    lon, lat = wgs84(F.col("x"), F.col("y"))
    rows = df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat}).collect()
    for r in rows[:2]:
        assert r.lon2 == pytest.approx(r.lon, abs=1e-5) and r.lat2 == pytest.approx(r.lat, abs=1e-5)
    assert rows[2].x is None and rows[2].y is None
    line = spark.sql("select array(named_struct('x', 8.70D, 'y', 47.49D), named_struct('x', 8.70D, 'y', 47.50D)) as l, "
                     "array(named_struct('x', 8.70D, 'y', 47.49D)) as one")
    r = line.select(line_length(F.col("l")).alias("l"), line_length(F.col("one")).alias("one")).first()
    assert r.l == pytest.approx(1111.9, abs=1) and r.one is None


def test_closed_projection(spark):
    """Agrees with the polynomials in Switzerland and goes on where they end."""
    df = spark.createDataFrame([(8.7, 47.49), (7.45, 46.95), (6.1, 46.2), (11.0, 47.0), (11.1, 47.0), (0.0, 0.0), (None, 47.0)],
                               "lon double, lat double")
    x, y = lv03(F.col("lon"), F.col("lat"))
    rows = with_lv03_anywhere(df.withColumns({"px": x, "py": y})).collect()
    for r in rows[:3]:
        assert r.x == pytest.approx(r.px, abs=1) and r.y == pytest.approx(r.py, abs=1)
    # 0.1 degrees of longitude at 47 degrees north.
    assert ((rows[4].x - rows[3].x) ** 2 + (rows[4].y - rows[3].y) ** 2) ** 0.5 == pytest.approx(7604, abs=5)
    assert rows[5].px is None and rows[5].y < -5e6 and rows[6].x is None
