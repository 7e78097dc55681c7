"""Nearest nodes where a grid cell may hold very many of them.

The nodes of a grid cell form a quadtree: a cell with more than ``LEAF_NODES`` nodes is divided
into four. Positions start with the cells around them and go down by levels, all at once. Of a
position's cells only those stay whose nearest possible node is no farther than the farthest one
of some other cell, so a few cells are left at every level, however many nodes they hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions.geo import great_circle, lv03
from curbline.session import broadcast_if_small, stage

# A cell with more nodes is divided, down to DEPTH levels below the grid (500 m: half a metre).
LEAF_NODES = 32
DEPTH = 10
# A broadcast cell or node takes about this many bytes in a hash relation.
ROW_BYTES = 160
_CELL = ["city_bfs_id", "mode", "level", "cx", "cy"]
_PLACE = ["city_bfs_id", "lon", "lat", "x", "y"]


def _deepest(width: float) -> tuple[Column, Column]:
    fine = width / 2 ** DEPTH
    return F.floor(F.col("x") / fine).alias("fx"), F.floor(F.col("y") / fine).alias("fy")


def _at(level: Column) -> list[Column]:
    """The cell of ``fx, fy`` at a level; cells of a level are halves of those above."""
    up = F.lit(DEPTH) - level
    return [F.call_function("shiftright", F.col("fx"), up).alias("cx"), F.call_function("shiftright", F.col("fy"), up).alias("cy")]


def tree(nodes: DataFrame, width: float) -> tuple[DataFrame, DataFrame]:
    """``cells``: all cells of the tree with the number and the box of their nodes; ``held``: each node with its leaf.

    Of nodes at one place the smallest id stays: it wins every tie.
    """
    x, y = lv03(F.col("lon"), F.col("lat"))
    alone = nodes.groupBy("city_bfs_id", "mode", "lon", "lat").agg(F.min("node_id").alias("node_id"))
    placed = alone.withColumns({"x": x, "y": y}).where("x is not null and y is not null").select("*", *_deepest(width))
    levels = placed.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(DEPTH)))).select("*", *_at(F.col("level")))
    counted = stage(levels.groupBy(*_CELL).agg(F.count("*").alias("n"), F.min("lon").alias("west"), F.max("lon").alias("east"),
                                               F.min("lat").alias("south"), F.max("lat").alias("north")), "quadtree")
    above = counted.where((F.col("n") > LEAF_NODES) & (F.col("level") < DEPTH)).select(
        "city_bfs_id", "mode", (F.col("level") + 1).alias("level"), F.col("cx").alias("px"), F.col("cy").alias("py"))
    kept = counted.withColumns({"px": F.expr("shiftright(cx, 1)"), "py": F.expr("shiftright(cy, 1)")})
    divided = kept.join(above, ["city_bfs_id", "mode", "level", "px", "py"], "left_semi")
    cells = stage(kept.where("level = 0").unionByName(divided).withColumn(
        "leaf", (F.col("n") <= LEAF_NODES) | (F.col("level") == DEPTH)), "quadtree-cells")
    held = stage(levels.join(cells.where("leaf").select(*_CELL), _CELL).select(
        *_CELL, "node_id", F.col("lon").alias("node_lon"), F.col("lat").alias("node_lat")), "quadtree-nodes")
    return cells, held


def _pruned(frontier: DataFrame) -> DataFrame:
    """Without the cells of a position that cannot hold its nearest node of the mode.

    ``least`` and ``most`` bound the squared half chord to the nodes of a cell's box, which grows with the
    great-circle length: the parts of longitude and latitude grow each for itself but for the cosine of
    the node's latitude, for which the box's smallest or largest stands.
    """
    west, east, south, north, lon, lat = (F.radians(F.col(c)) for c in ("west", "east", "south", "north", "lon", "lat"))
    off = lambda low, high, v: F.greatest(low - v, v - high, F.lit(0.0))
    far = lambda low, high, v: F.greatest(F.abs(low - v), F.abs(high - v))
    chord = lambda up, side, cosine: F.pow(F.sin(up / 2), 2) + F.cos(lat) * cosine * F.pow(F.sin(side / 2), 2)
    widest = F.when((south < 0) & (north > 0), 1.0).otherwise(F.greatest(F.cos(south), F.cos(north)))
    bounded = frontier.withColumns({
        "least": chord(off(south, north, lat), off(west, east, lon), F.least(F.cos(south), F.cos(north))),
        "most": chord(far(south, north, lat), far(west, east, lon), widest)})
    reach = F.min("most").over(Window.partitionBy(*_PLACE, "mode"))
    # Rounding must not tell apart what may be equal.
    return bounded.withColumn("reach", reach).where(F.col("least") <= F.col("reach") * (1 + 1e-9)).drop("least", "most", "reach")


def near_leaves(places: DataFrame, cells: DataFrame, width: float) -> DataFrame:
    """The leaves that may hold the nearest node of each place: ``city_bfs_id, lon, lat, x, y, mode, level, cx, cy``.

    Nodes outside the nine grid cells around a place are not looked at. One round for a level of the tree.
    """
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    start = (places.select("*", *_deepest(width)).select(*_PLACE, *_at(F.lit(0)), F.explode(around).alias("d"))
             .select(*_PLACE, (F.col("cx") + F.col("d.i")).alias("cx"), (F.col("cy") + F.col("d.j")).alias("cy")))
    top = broadcast_if_small(cells.where("level = 0").drop("px", "py"), ROW_BYTES)
    frontier = stage(_pruned(start.join(top, ["city_bfs_id", "cx", "cy"])), "quadtree-round")
    for level in range(1, DEPTH + 1):
        done, going = frontier.where("leaf"), frontier.where("not leaf")
        if going.isEmpty():
            break
        below = broadcast_if_small(cells.where(F.col("level") == level), ROW_BYTES)
        parents = going.select(*_PLACE, "mode", F.col("cx").alias("px"), F.col("cy").alias("py"))
        opened = parents.join(below, ["city_bfs_id", "mode", "px", "py"]).drop("px", "py")
        frontier = stage(_pruned(done.unionByName(opened)), "quadtree-round")
    return frontier.select(*_PLACE, *_CELL[1:])


def crowded(nodes: DataFrame, width: float) -> bool:
    """Whether a grid cell of this width holds more nodes of a mode than a leaf does."""
    x, y = lv03(F.col("lon"), F.col("lat"))
    counts = nodes.groupBy("city_bfs_id", "mode", F.floor(x / width), F.floor(y / width)).count()
    return not counts.where(F.col("count") > LEAF_NODES).isEmpty()


def snap(points: DataFrame, tree_of: tuple[DataFrame, DataFrame], key: Sequence[str], modes: Sequence[str],
         width: float) -> DataFrame:
    """``points`` with the best node per mode of the nine cells around; places that repeat are searched once."""
    cells, held = tree_of
    places = points.select(*_PLACE).where("lon is not null and lat is not null and x is not null and y is not null").distinct()
    leaves = near_leaves(places, cells, width)
    ranked = F.struct(great_circle(F.col("lon"), F.col("lat"), F.col("node_lon"), F.col("node_lat")).alias("m"), "node_id")
    best = (leaves.join(broadcast_if_small(held, ROW_BYTES), _CELL).groupBy("city_bfs_id", "lon", "lat", "x", "y")
            .agg(*[F.min(F.when(F.col("mode") == m, ranked)).alias(f"best_{m}") for m in modes]))
    columns = [*key, *[c for c in points.columns if c not in key]]
    return points.join(best, _PLACE, "left").select(
        *columns, *[F.col(f"best_{m}.node_id").alias(f"node_{m}") for m in modes],
        *[F.col(f"best_{m}.m").alias(f"node_{m}_m") for m in modes])
