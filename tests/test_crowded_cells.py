"""Nearest nodes in a dense city, against all nodes of the grid cells around."""

import random

from pyspark.sql import functions as F

from curbline.functions.geo import lv03
from curbline.operators import crowded_cells, nearest
from curbline.sources.streets import MODES

CITY = (8.54, 47.37)
# A degree of longitude and latitude there, in metres, roughly.
EAST, NORTH = 75400.0, 111200.0


def _city(rng, count):
    """Most nodes in one square kilometre, some of them at one place, a few around it."""
    for number in range(count):
        side = 8.0 if number % 10 == 0 else 1000.0
        yield number, CITY[0] + rng.uniform(0, side) / EAST, CITY[1] + rng.uniform(0, side) / NORTH
    for number in range(count, count + 80):
        yield number, CITY[0] + 300 / EAST, CITY[1] + 300 / NORTH


def _frames(spark, nodes, positions):
    node_df = spark.createDataFrame([(261, "walk" if n % 3 else "bike", n, lon, lat) for n, lon, lat in nodes],
                                    "city_bfs_id int, mode string, node_id long, lon double, lat double")
    x, y = lv03(F.col("lon"), F.col("lat"))
    points = spark.createDataFrame([(261, f"v{k}", lon, lat) for k, (lon, lat) in enumerate(positions)],
                                   "city_bfs_id int, id string, lon double, lat double").withColumns({"x": x, "y": y})
    return node_df, points


def _found(rows):
    return {r.id: (r.node_walk, r.node_bike, r.node_walk_m, r.node_bike_m) for r in rows.collect()}


def test_dense_city(spark):
    rng = random.Random(5)
    nodes = list(_city(rng, 50000))
    positions = [(CITY[0] + rng.uniform(-400, 1400) / EAST, CITY[1] + rng.uniform(-400, 1400) / NORTH) for _ in range(150)]
    positions += [nodes[k][1:] for k in (0, 7, 40000, 50001)] + [positions[0], (None, None)]
    node_df, points = _frames(spark, nodes, positions)
    key = ["city_bfs_id", "id"]
    assert crowded_cells.crowded(node_df, nearest.CELL_M)
    made = crowded_cells.tree(node_df, nearest.CELL_M)
    got = _found(crowded_cells.snap(points, made, key, MODES, nearest.CELL_M))
    assert got == _found(nearest._snap(points, node_df, key, MODES, nearest.CELL_M))
    assert got["v155"] == (None, None, None, None) and got["v153"][0] is not None

    cells, held = made
    places = points.where("lon is not null").select("city_bfs_id", "lon", "lat", "x", "y").distinct()
    leaves = crowded_cells.near_leaves(places, cells, nearest.CELL_M)
    candidates = leaves.join(held, ["city_bfs_id", "mode", "level", "cx", "cy"]).groupBy("x", "y", "mode").count()
    most, mean = candidates.agg(F.max("count"), F.avg("count")).first()
    print("candidates of a position and mode: most", most, "mean", mean)
    assert most <= 40 * crowded_cells.LEAF_NODES and mean <= 6 * crowded_cells.LEAF_NODES
    # Every node is held by one leaf, but for those at one place.
    assert held.count() == node_df.select("mode", "lon", "lat").distinct().count() and held.where("node_id > 50002").isEmpty()


def test_widening_grids_and_missing_modes(spark):
    """Positions far outside reach the city on wider grids; a mode without nodes gives null."""
    rng = random.Random(8)
    nodes = [n for n in _city(rng, 900) if n[0] % 3]
    positions = [(CITY[0] + d / EAST, CITY[1]) for d in (-3000.0, -700.0, 20.0, 500.0, 2500.0)]
    node_df, points = _frames(spark, nodes, positions)
    got = _found(nearest.nearest_nodes(points, node_df, ["city_bfs_id", "id"]))
    wide = _found(nearest._snap(points, node_df, ["city_bfs_id", "id"], MODES, 8000.0))
    assert got == wide and all(r[0] is not None and r[1] is None for r in got.values())
