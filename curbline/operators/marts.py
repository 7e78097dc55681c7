"""Data marts over the path table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.functions.geo import mercator, planar_distance
from curbline.functions.timing import Interval, same_day_range, ts
from curbline.operators.stays import SLICE_SECONDS, SORTED_SLICE, SORTED_VEHICLE, VEHICLE, time_slice

HOUR_US = 3_600_000_000


def path_vertices(path: DataFrame) -> DataFrame:
    """One row per vertex of the walking path, numbered from 1; a null path has none."""
    return path.select("*", F.posexplode("path_walk_since_last").alias("_pos", "vertex")).withColumn(
        "path_idx", (F.col("_pos") + 1).cast("int")).drop("_pos")


def _mercator_distance(a: str, b: str) -> Column:
    ax, ay = mercator(F.col(f"{a}.x"), F.col(f"{a}.y"))
    bx, by = mercator(F.col(f"{b}.x"), F.col(f"{b}.y"))
    return planar_distance(ax, ay, bx, by)


def edges(path: DataFrame, interval: Interval, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Vertices of the interval's walking paths with the vehicle's previous vertex.

    The order is per (region, vehicle) by ``time_to`` and vertex number. Paths travel to
    their time slice whole and are expanded there; the last vertex of each slice is
    carried into the next one.
    """
    keys = list(SORTED_SLICE)
    rows = (path.where(interval.covers(F.col("time_from")) & F.col("path_walk_since_last").isNotNull())
            .select(*VEHICLE, "provider", "time_from", "time_to", "path_walk_since_last")
            .withColumn("slice", time_slice(F.col("time_to"), slice_seconds)))
    tails = rows.groupBy(*keys).agg(F.max(F.struct(
        "time_to", F.size("path_walk_since_last").alias("n"), "time_from",
        F.element_at("path_walk_since_last", -1).alias("point"))).alias("tail"))
    carried = tails.select(*keys, F.lag("tail.point").over(
        W.partitionBy(*SORTED_VEHICLE).orderBy("slice")).alias("carried"))
    in_slice = W.partitionBy(*keys).orderBy("time_to", "path_idx", "time_from")
    vertices = path_vertices(rows.repartition(*keys)).withColumn("before", F.lag("vertex").over(in_slice))
    return (vertices.join(carried, keys, "left")
            .withColumn("point_before", F.coalesce("before", "carried"))
            .select("id", "provider", "city_bfs_id", "time_from", "time_to", "path_idx",
                    F.col("vertex").alias("point"), "point_before",
                    _mercator_distance("point_before", "vertex").alias("distance_m")))


def distinct_vehicles(path: DataFrame, moment: dt.datetime | str | None = None) -> DataFrame:
    """Vehicles per day, provider and region: for the day of ``moment``, or for every day."""
    rows = path if moment is None else path.where(same_day_range(F.col("time_from"), moment))
    return rows.groupBy("provider", "city_bfs_id", F.date_trunc("day", "time_from").alias("time")).agg(
        F.count_distinct("id").alias("distinct_ids"))


def vehicle_age(path: DataFrame, interval: Interval) -> DataFrame:
    """Mean age in days of the vehicles alive at each full hour of the interval.

    A vehicle counts at the hour marks one hour and later after the hour it was first
    seen in, while its age allows. Instead of one row per vehicle and hour, each vehicle
    sends two rows, at its first mark and after its last; running totals over the hours
    then give the number alive and the sum of their first times, exactly.
    """
    lives = path.groupBy("id", "provider", "city_bfs_id").agg(
        F.min(F.unix_micros("time_from")).alias("born"), F.max(F.unix_micros("time_to")).alias("died"))
    start = F.lit(int(interval.start.timestamp() * 1_000_000))
    end = F.lit(int(interval.end.timestamp() * 1_000_000))
    hour0 = F.floor(F.col("born") / HOUR_US)
    marks = lives.select(
        "provider", "city_bfs_id", "born",
        F.greatest(hour0 + 1, F.ceil(start / HOUR_US)).alias("first"),
        F.least(hour0 + F.floor((F.col("died") - F.col("born")) / HOUR_US), F.floor(end / HOUR_US)).alias("last"))
    born = F.col("born").cast("decimal(20,0)")
    changes = marks.where("first <= last").select("provider", "city_bfs_id", F.inline(F.array(
        F.struct(F.col("first").alias("hour"), F.lit(1).alias("n"), born.alias("born")),
        F.struct((F.col("last") + 1).alias("hour"), F.lit(-1).alias("n"), (-born).alias("born")))))
    hours = changes.groupBy("provider", "city_bfs_id", "hour").agg(
        F.sum("n").alias("n"), F.sum("born").alias("born"))
    by_hour = W.partitionBy("provider", "city_bfs_id").orderBy("hour")
    so_far = by_hour.rowsBetween(W.unboundedPreceding, W.currentRow)
    alive = hours.select(
        "provider", "city_bfs_id", "hour", F.lead("hour").over(by_hour).alias("until"),
        F.sum("n").over(so_far).alias("n"), F.sum("born").over(so_far).alias("born"))
    marked = alive.where("n > 0").select(
        "provider", "city_bfs_id", "n", "born", F.explode(F.expr("sequence(hour, until - 1)")).alias("hour"))
    age = (F.col("hour") * HOUR_US - F.col("born") / F.col("n")).cast("double") / 86_400_000_000
    return marked.select(
        F.timestamp_micros(F.col("hour") * HOUR_US).alias("time"), "city_bfs_id", "provider",
        age.alias("avg_age_days_scooter"))


def trip_numbers(path: DataFrame, interval: Interval, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """The interval's path rows with ``trip_id``: how many standing rows the vehicle has had
    so far, over all regions and its whole history.

    Rows before the interval only enter as one count per vehicle, and inside it the count
    runs per time slice with the totals of the earlier slices added.
    """
    standing = F.when(F.col("moving"), 0).otherwise(1)
    rows = path.withColumn("standing", standing)
    before = rows.where(F.col("time_from") < ts(interval.start)).groupBy("id").agg(F.sum("standing").alias("earlier"))
    inside = rows.where(interval.covers(F.col("time_from"))).withColumn(
        "slice", time_slice(F.col("time_from"), slice_seconds))
    earlier = W.partitionBy("id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    totals = (inside.groupBy("id", "slice").agg(F.sum("standing").alias("n"))
              .withColumn("passed", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .join(before, "id", "left")
              .select("id", "slice", (F.col("passed") + F.coalesce("earlier", F.lit(0))).alias("base")))
    running = F.sum("standing").over(W.partitionBy("id", "slice").orderBy("time_from"))
    return (inside.withColumn("running", running).join(totals, ["id", "slice"])
            .withColumn("trip_id", F.col("base") + F.col("running"))
            .drop("standing", "slice", "running", "base"))


def trip_distance(path: DataFrame, interval: Interval) -> DataFrame:
    """Length of each trip: a standing row plus the moving rows after it, as far as they
    start inside the interval."""
    needed = path.select("id", "provider", "city_bfs_id", "time_from", "moving", "distance_m_walk", "distance_m_bike")
    return (trip_numbers(needed, interval)
            .groupBy("id", "provider", "city_bfs_id", F.col("trip_id").cast("string").alias("trip_id"))
            .agg(F.min("time_from").alias("trip_start"), F.max("time_from").alias("trip_end"),
                 F.sum("distance_m_walk").alias("trip_walk_distance_m"),
                 F.sum("distance_m_bike").alias("trip_bike_distance_m")))


def one_row_per_trip(trips: DataFrame) -> DataFrame:
    """Fold trips that changed provider or region to the table's key; the latest part names them."""
    return trips.groupBy("id", "trip_id").agg(
        F.max(F.struct("trip_end", "trip_start", "provider", "city_bfs_id")).alias("latest"),
        F.min("trip_start").alias("trip_start"), F.max("trip_end").alias("trip_end"),
        F.sum("trip_walk_distance_m").alias("trip_walk_distance_m"),
        F.sum("trip_bike_distance_m").alias("trip_bike_distance_m"),
    ).select("id", F.col("latest.provider").alias("provider"), F.col("latest.city_bfs_id").alias("city_bfs_id"),
             "trip_id", "trip_start", "trip_end", "trip_walk_distance_m", "trip_bike_distance_m")
