"""Routed paths between stays: history stitching, routing and the path rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.functions.geo import point
from curbline.functions.timing import Interval, ts
from curbline.operators.nearest import nearest_nodes
from curbline.operators.routing import pairs_from, path_lines, shortest_paths
from curbline.operators.stays import VEHICLE, segment, with_previous
from curbline.regions import MOVE_THRESHOLD_M, REGIONS, Region, region_rank
from curbline.session import stage
from curbline.sources.streets import MODES

HISTORY_DAYS = 30
HISTORY_ROWS = 2


def recent_stays(path: DataFrame, start: dt.datetime | str, rows: int = HISTORY_ROWS) -> DataFrame:
    """The last stored stays of every vehicle in the 30 days up to ``start`` (both ends in).

    The row limit is applied before the shuffle, so a vehicle sends at most ``rows`` rows
    per task.
    """
    horizon = ts(start) - F.expr(f"interval {HISTORY_DAYS} days")
    latest = W.partitionBy("id").orderBy(F.desc("time_to"), F.desc("time_from"))
    return (path.where(F.col("time_to").between(horizon, ts(start)))
            .withColumn("r", F.row_number().over(latest)).where(F.col("r") <= rows)
            .select("id", "provider", F.col("time_from").alias("time"),
                    F.col("point.x").alias("lon"), F.col("point.y").alias("lat"), "r"))


def stitch(points: DataFrame, history: DataFrame, start: dt.datetime | str) -> DataFrame:
    """New observations plus the stored stays of the vehicles that were seen after ``start``.

    A stored stay is one observation at its start, placed in every region its vehicle
    was now seen in.
    """
    seen = points.where(F.col("time") > ts(start)).select(*VEHICLE).distinct()
    stored = history.join(seen, "id").select(
        "id", "provider", "time", F.lit(None).cast("timestamp").alias("runtime"),
        "lon", "lat", "city_bfs_id", F.lit(0).alias("source_rank"))
    return points.select("id", "provider", "time", "runtime", "lon", "lat", "city_bfs_id",
                         F.lit(1).alias("source_rank")).unionByName(stored)


def snapped_stays(stays: DataFrame, nodes: DataFrame, modes: Sequence[str] = MODES) -> DataFrame:
    """Stays with their nearest node per mode and, as ``previous``, those of the stay before."""
    key = (*VEHICLE, "stay")
    near = nearest_nodes(stays, nodes, key, modes)
    return with_previous(near, [f"node_{m}" for m in modes])


def routed(stays: DataFrame, nodes: DataFrame, edges: DataFrame, modes: Sequence[str] = MODES) -> DataFrame:
    """Stays with the line and length of the way from the previous stay, per mode.

    Each distinct pair of nodes is routed once. No way (same node, unreachable) is null.
    """
    snapped = stage(snapped_stays(stays, nodes, modes), "snapped")
    ways = stage(path_lines(shortest_paths(
        pairs_from(snapped, tuple(modes)).where("origin <> destination"), edges), nodes), "ways")
    result = snapped
    for m in modes:
        way = ways.where(F.col("mode") == m).select(
            "city_bfs_id", F.col("origin").alias(f"_from_{m}"), F.col("destination").alias(f"node_{m}"),
            F.col("line_m").alias(f"distance_m_{m}"), F.col("line").alias(f"path_{m}_since_last"))
        result = (result.withColumn(f"_from_{m}", F.col(f"previous.node_{m}"))
                  .join(way, ["city_bfs_id", f"_from_{m}", f"node_{m}"], "left"))
    return result


def path_rows(stays: DataFrame, start: dt.datetime | str, modes: Sequence[str] = MODES) -> DataFrame:
    """Routed stays as path rows: those ending in or after the interval, without any null."""
    rows = stays.select(
        "id", "provider", "city_bfs_id", point(F.col("lon"), F.col("lat")).alias("point"),
        "time_from", "time_to", "distance_m", "moving",
        *[c for m in modes for c in (f"distance_m_{m}", f"path_{m}_since_last")])
    return rows.where(F.col("time_to") >= ts(start)).na.drop("any")


def one_region_per_key(rows: DataFrame, regions: Sequence[Region] = REGIONS) -> DataFrame:
    """The key has no region, and boxes overlap: the region last in the list keeps the row.

    Hardly any key repeats, so rows move at once: nothing would be gained by combining them before.
    """
    columns = rows.columns
    last_first = W.partitionBy("time_from", "id").orderBy(*[F.desc(c) for c in ("_rank", *columns)])
    return (rows.withColumn("_rank", region_rank(F.col("city_bfs_id"), regions))
            .withColumn("_other", F.lag(F.lit(True)).over(last_first))
            .where(F.col("_other").isNull()).select(*columns))


def build_paths(points: DataFrame, nodes: DataFrame, edges: DataFrame, interval: Interval,
                path: DataFrame | None = None, regions: Sequence[Region] = REGIONS,
                threshold_m: float = MOVE_THRESHOLD_M) -> DataFrame:
    """Path rows of an interval from its region-tagged points and the stored path table."""
    if path is not None:
        points = stitch(points, recent_stays(path, interval.start), interval.start)
    stays = stage(segment(points, threshold_m, active_after=interval.start), "stays")
    rows = path_rows(routed(stays, nodes, edges), interval.start)
    return one_region_per_key(rows, regions)
