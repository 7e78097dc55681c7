"""Nearest street node of each position, per mode.

Nodes, the small and slowly changing side, are published to the nine grid cells around
them; positions join on their own cell only, so the large side is neither copied nor
shuffled when the planner finds the nodes small enough to broadcast. A match is final
when it is no farther than the cell width, which the nine cells always cover; the
positions left over go on to a grid of twice the width. Where a cell of the grid is crowded,
quadtrees stand in for its nodes (``crowded_cells``), so a position meets few of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.geo import great_circle, lv03
from curbline.operators import crowded_cells
from curbline.session import broadcast_if_small, stage
from curbline.sources.streets import MODES

CELL_M = 500.0
# A broadcast node takes about this many bytes in a hash relation.
NODE_BYTES = 120
# Great-circle and LV03 lengths differ by less than this factor inside a region.
CELL_SAFETY = 0.99


def _cell(x: Column, y: Column, width: float) -> list[Column]:
    return [F.floor(x / width).alias("cx"), F.floor(y / width).alias("cy")]


def _published(nodes: DataFrame, width: float) -> DataFrame:
    x, y = lv03(F.col("lon"), F.col("lat"))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
                       for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return (nodes.withColumns({"x": x, "y": y})
            .withColumn("d", F.explode(around))
            .select("city_bfs_id", "mode", "node_id", F.col("lon").alias("node_lon"), F.col("lat").alias("node_lat"),
                    (F.floor(F.col("x") / width) + F.col("d.i")).alias("cx"),
                    (F.floor(F.col("y") / width) + F.col("d.j")).alias("cy")))


def _snap(points: DataFrame, nodes: DataFrame, key: Sequence[str], modes: Sequence[str], width: float) -> DataFrame:
    """Best node per mode among the surrounding cells; null where they hold none."""
    payload = [c for c in points.columns if c not in key]
    placed = points.select("*", *_cell(F.col("x"), F.col("y"), width))
    near = placed.join(broadcast_if_small(_published(nodes, width), NODE_BYTES), ["city_bfs_id", "cx", "cy"], "left")
    ranked = F.struct(great_circle(F.col("lon"), F.col("lat"), F.col("node_lon"), F.col("node_lat")).alias("m"),
                      "node_id")
    best = [F.min(F.when(F.col("mode") == m, ranked)).alias(f"best_{m}") for m in modes]
    return (near.groupBy(*key).agg(F.first(F.struct(*payload)).alias("kept"), *best)
            .select(*key, *[F.col(f"kept.{c}").alias(c) for c in payload],
                    *[F.col(f"best_{m}.node_id").alias(f"node_{m}") for m in modes],
                    *[F.col(f"best_{m}.m").alias(f"node_{m}_m") for m in modes]))


def nearest_nodes(points: DataFrame, nodes: DataFrame, key: Sequence[str],
                  modes: Sequence[str] = MODES, cell_m: float = CELL_M) -> DataFrame:
    """Add ``node_<mode>`` and its great-circle distance ``node_<mode>_m``.

    ``points`` needs ``city_bfs_id, lon, lat, x, y`` and a unique ``key`` that includes
    ``city_bfs_id``; ties go to the smaller node id. Grids widen until every position has
    its node, however far; only a position without coordinates, or a mode without any
    node in the region, gives null. Each grid runs as one job, and nearly always only the
    first has rows to place.
    """
    key = list(key)
    columns = points.columns
    # Regions that have a node on the grid: one row per region and mode.
    on_grid = F.col("city_bfs_id").isNotNull() & lv03(F.col("lon"), F.col("lat"))[0].isNotNull()
    covered = {m: [r[0] for r in nodes.where((F.col("mode") == m) & on_grid).select("city_bfs_id").distinct().collect()]
               for m in modes}
    placed = F.coalesce(F.col("x") - F.col("x") == 0, F.lit(False)) & F.coalesce(F.col("y") - F.col("y") == 0, F.lit(False))
    width, rest, found = cell_m, points, []
    while True:
        if crowded_cells.crowded(nodes, width):
            best = crowded_cells.snap(rest, crowded_cells.tree(nodes, width), key, modes, width)
        else:
            best = _snap(rest, nodes, key, modes, width)
        snapped = stage(best, "nearest")
        settled = F.lit(True)
        for m in modes:
            near = F.coalesce(F.col(f"node_{m}_m") <= width * CELL_SAFETY, F.lit(False))
            nowhere = ~F.coalesce(F.col("city_bfs_id").isin(covered[m]), F.lit(False)) if covered[m] else F.lit(True)
            settled = settled & (near | nowhere)
        settled = settled | ~placed
        found.append(snapped.where(settled))
        rest = snapped.where(~settled).select(columns)
        if rest.isEmpty():
            break
        width = width * 2
    return reduce(DataFrame.unionByName, found)
