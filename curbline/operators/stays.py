"""Split each vehicle's track into stays.

A stay is a maximal run of observations whose steps are at most the threshold. The
running quantities this needs (previous position, number of moves so far) are per
vehicle and in time order, but no window ever holds a whole vehicle: rows are windowed
within (region, vehicle, time slice), and one summary row per slice carries the last
position and the number of moves over to the next slice. Observations of one vehicle at
one time are first reduced to one, with map-side combining, so repeated snapshots of a
busy vehicle are gone before anything is sorted by vehicle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.functions.geo import lv03, planar_distance, wgs84
from curbline.functions.timing import ts
from curbline.regions import MOVE_THRESHOLD_M

VEHICLE = ("city_bfs_id", "id")
# The same keys in the order rows are sorted by. A sort compares the first eight bytes of its first column before it looks
# at a row, so a column of many values comes first, never the region.
SORTED_VEHICLE = ("id", "city_bfs_id")
SORTED_SLICE = ("slice", *SORTED_VEHICLE)
# One day: 720 collection ticks, and at most 86,400 distinct refresh times, which are epoch
# seconds. Vehicles that are seen less than once an hour would have as many shorter slices as rows.
SLICE_SECONDS = 86400
# Stay numbers a window holds when a stay meets the one before it.
STAY_BLOCK = 64


def time_slice(column: Column, seconds: int = SLICE_SECONDS) -> Column:
    # Never null, so that joins by slice infer no filter: it would reach only one of the two
    # scans of the same rows and keep them from sharing a shuffle.
    return F.coalesce(F.floor(F.unix_seconds(column) / seconds), F.lit(0))


def distinct_observations(points: DataFrame) -> DataFrame:
    """One row per (region, vehicle, time): stored history first, then the earliest
    collection run, then the smallest coordinates."""
    rank = F.col("source_rank") if "source_rank" in points.columns else F.lit(1)
    best = F.min(F.struct(rank.alias("source_rank"), "runtime", "lon", "lat", "provider")).alias("best")
    return points.groupBy("time", *SORTED_VEHICLE).agg(best).select(
        *VEHICLE, "time", "best.provider", "best.source_rank", "best.runtime", "best.lon", "best.lat")


def with_lv03(df: DataFrame) -> DataFrame:
    x, y = lv03(F.col("lon"), F.col("lat"))
    return df.withColumns({"x": x, "y": y})


def _step(before: str) -> Column:
    return planar_distance(F.col(f"{before}.x"), F.col(f"{before}.y"), F.col("x"), F.col("y"))


def _moved(step: Column, threshold_m: float) -> Column:
    return F.coalesce(step > threshold_m, F.lit(False))


def steps(points: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Distance of every observation from the vehicle's previous one, in metres."""
    keys = [*VEHICLE, "slice"]
    rows = points.withColumn("slice", time_slice(F.col("time"), slice_seconds))
    in_slice = W.partitionBy(*keys).orderBy("time")
    tails = rows.groupBy(*keys).agg(F.max(F.struct("time", "x", "y")).alias("tail"))
    carried = tails.select(*keys, F.lag("tail").over(W.partitionBy(*VEHICLE).orderBy("slice")).alias("carried"))
    before = rows.withColumn("before", F.lag(F.struct("time", "x", "y")).over(in_slice))
    return (before.join(carried, keys, "left")
            .withColumn("before", F.coalesce("before", "carried"))
            .withColumn("distance_m", _step("before"))
            .drop("slice", "before", "carried"))


def _walk(points: DataFrame, threshold_m: float, slice_seconds: int) -> DataFrame:
    """Observations with the step from the one before and the moves so far, within one slice."""
    keys = list(SORTED_SLICE)
    # Provider is unique per time; ordering by it as well keeps both readers of this
    # frame on one shuffle.
    in_slice = W.partitionBy(*keys).orderBy("time", "provider")
    so_far = in_slice.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (points.withColumn("slice", time_slice(F.col("time"), slice_seconds))
            .select(*keys, "time", "provider", "x", "y")
            .withColumn("before", F.lag(F.struct("x", "y")).over(in_slice))
            .withColumn("step", _step("before"))
            .withColumn("moved", _moved(F.col("step"), threshold_m))
            .withColumn("run", F.sum(F.col("moved").cast("int")).over(so_far))
            .drop("before"))


def _carry(walked: DataFrame, threshold_m: float) -> DataFrame:
    """Per slice: step into it, the number of its first stay, the vehicle's last time."""
    keys = list(SORTED_SLICE)
    at = F.struct("time", "x", "y")
    slices = walked.groupBy(*keys).agg(
        F.min(at).alias("head"), F.max(at).alias("tail"), F.max("run").alias("moves"))
    in_order = W.partitionBy(*SORTED_VEHICLE).orderBy("slice")
    earlier = in_order.rowsBetween(W.unboundedPreceding, -1)
    entered = (slices.withColumn("before", F.lag("tail").over(in_order))
               .withColumn("head_step", planar_distance(
                   F.col("before.x"), F.col("before.y"), F.col("head.x"), F.col("head.y")))
               .withColumn("head_moved", _moved(F.col("head_step"), threshold_m))
               .withColumn("entry", F.col("head_moved").cast("int")))
    return entered.select(
        *keys, F.col("head.time").alias("head_time"), "head_step", "head_moved",
        (F.coalesce(F.sum(F.col("entry") + F.col("moves")).over(earlier), F.lit(0))
         + F.col("entry")).alias("base"),
        F.max("tail.time").over(W.partitionBy(*SORTED_VEHICLE)).alias("vehicle_last"))


def segment(points: DataFrame, threshold_m: float = MOVE_THRESHOLD_M,
            active_after: dt.datetime | str | None = None,
            slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Stays of every vehicle: ``city_bfs_id, id, stay, provider, time_from, time_to,
    distance_m, moving, x, y, lon, lat``.

    ``points`` are region-tagged observations (``scan_points``), optionally with
    ``source_rank`` 0 for stitched history. With ``active_after``, vehicles whose last
    observation is not later are left out. ``distance_m`` is the step into the stay's
    first observation; the position is the mean of the stay's distinct positions.
    """
    walked = _walk(with_lv03(distinct_observations(points)), threshold_m, slice_seconds)
    carry = _carry(walked, threshold_m)
    if active_after is not None:
        carry = carry.where(F.col("vehicle_last") > ts(active_after))
    at_head = F.col("time") == F.col("head_time")
    numbered = walked.join(carry, list(SORTED_SLICE)).select(
        *VEHICLE, (F.col("base") + F.col("run")).alias("stay"), "x", "y", "time",
        F.when(at_head, F.col("head_step")).otherwise(F.col("step")).alias("step"),
        F.when(at_head, F.col("head_moved")).otherwise(F.col("moved")).alias("moved"), "provider")
    positions = numbered.groupBy("x", "id", "stay", "y", "city_bfs_id").agg(
        F.min(F.struct("time", "step", "moved", "provider")).alias("first"), F.max("time").alias("last_time"))
    stays = positions.groupBy("id", "stay", "city_bfs_id").agg(
        F.min("first").alias("first"), F.max("last_time").alias("time_to"),
        F.avg("x").alias("x"), F.avg("y").alias("y"))
    lon, lat = wgs84(F.col("x"), F.col("y"))
    return stays.select(
        *VEHICLE, "stay", F.col("first.provider").alias("provider"),
        F.col("first.time").alias("time_from"), "time_to",
        F.coalesce("first.step", F.lit(0.0)).alias("distance_m"),
        ((F.col("first.time") == F.col("time_to")) & F.col("first.moved")).alias("moving"),
        "x", "y", lon.alias("lon"), lat.alias("lat"))


def with_previous(stays: DataFrame, values: list[str], key: tuple[str, ...] = SORTED_VEHICLE,
                  number: str = "stay") -> DataFrame:
    """Add ``previous``: a struct of ``values`` of the row numbered one lower.

    Stay numbers are consecutive, so rows are dealt by (vehicle, block of numbers) and the last
    one of a block is sent to the next block as well. No window per vehicle is needed, and of rows
    that share a number one stays.
    """
    block = F.floor(F.col(number) / STAY_BLOCK)
    ends = F.pmod(F.col(number), F.lit(STAY_BLOCK)) == STAY_BLOCK - 1
    sent = stays.withColumn("_block", F.explode(F.when(ends, F.array(block, block + 1)).otherwise(F.array(block))))
    in_block = W.partitionBy(*key, "_block").orderBy(number)
    return (sent.withColumns({"_n": F.lag(number).over(in_block), "previous": F.lag(F.struct(*values)).over(in_block)})
            .where(F.col("_block").eqNullSafe(block) & ~F.col(number).eqNullSafe(F.col("_n")))
            .withColumn("previous", F.when(F.col("_n") == F.col(number) - 1, F.col("previous")))
            .drop("_block", "_n"))
