from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from curbline.session import build_session  # noqa: E402

# One vehicle's track (time, lon, lat) of 2023-01-01. It stands, passes one
# moving point, stands, and stands again.
TRACK = [
    ("01:27:15", 8.706381, 47.491064), ("01:29:15", 8.706391, 47.491006), ("01:39:15", 8.706518, 47.491074),
    ("01:41:15", 8.711705, 47.494676), ("01:43:15", 8.717190, 47.497948), ("01:45:15", 8.717010, 47.497787),
    ("02:38:15", 8.721693, 47.498574), ("02:40:15", 8.721693, 47.498574),
]
# Times at which a standing vehicle repeats the first three positions.
STANDING = ["01:27:15", "01:29:15", "01:39:15", "01:42:15", "01:44:15", "01:47:15", "01:51:15", "01:56:15", "02:01:13"]


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


def documents(track, provider="Bolt", vehicle="bolt:1"):
    return [{"geometry": {"coordinates": [lon, lat]}, "properties": {"provider": {"name": provider}},
             "id": vehicle, "_meta_last_updated_utc": f"2023-01-01 {time}"} for time, lon, lat in track]


@pytest.fixture
def json_documents(spark, tmp_path):
    """Write documents as a JSON array file and read them with the document reader."""
    from curbline.sources.observations import read_documents

    def load(rows, name="documents"):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(rows, indent=1))
        return read_documents(spark, str(path))
    return load


def street_grid(spark, size=24, west=8.69, south=47.485, step=0.002):
    """A square two-way grid over the track, both modes; node ids count row by row."""
    from curbline.functions.geo import great_circle
    from pyspark.sql import functions as F

    rows = [(230, mode, r * size + c, west + c * step, south + r * step)
            for mode in ("walk", "bike") for r in range(size) for c in range(size)]
    nodes = spark.createDataFrame(rows, "city_bfs_id int, mode string, node_id bigint, lon double, lat double")
    links = [(r * size + c, (r + dr) * size + c + dc)
             for r in range(size) for c in range(size) for dr, dc in ((0, 1), (1, 0))
             if r + dr < size and c + dc < size]
    pairs = spark.createDataFrame([(230, m, *p) for m in ("walk", "bike") for u, v in links for p in ((u, v), (v, u))],
                                  "city_bfs_id int, mode string, u bigint, v bigint")
    a = nodes.select("city_bfs_id", "mode", F.col("node_id").alias("u"), F.col("lon").alias("ax"), F.col("lat").alias("ay"))
    b = nodes.select("city_bfs_id", "mode", F.col("node_id").alias("v"), F.col("lon").alias("bx"), F.col("lat").alias("by"))
    edges = (pairs.join(a, ["city_bfs_id", "mode", "u"]).join(b, ["city_bfs_id", "mode", "v"])
             .withColumn("length_m", great_circle(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))
             .select("city_bfs_id", "mode", "u", "v", "length_m"))
    return nodes, edges


@pytest.fixture(scope="session")
def streets(spark):
    nodes, edges = street_grid(spark)
    return nodes.cache(), edges.cache()
