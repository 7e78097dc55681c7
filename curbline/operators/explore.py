"""Exploration helpers, over all vehicles at once.

Rows come from ``sources.observations.explore``. Order within a vehicle is by collection
time; rows of one collection time are ordered by provider time and position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.functions.geo import planar_distance, with_lv03_anywhere
from curbline.functions.timing import seconds_between, to_zone
from curbline.operators.stays import SLICE_SECONDS, time_slice

ORDER = ("time_airflow", "time_provider", "lon", "lat")


def convert_time_zone(df: DataFrame, columns: Sequence[str], zone_from: str = "UTC",
                      zone_to: str = "Europe/Zurich") -> DataFrame:
    """Replace the columns by their wall-clock time in another zone."""
    return df.withColumns({c: to_zone(F.col(c), zone_from, zone_to) for c in columns})


def distance_from_point(df: DataFrame, x: float, y: float) -> DataFrame:
    """Add ``distance_m`` from a fixed point given in LV03 metres."""
    distance = planar_distance(F.col("x"), F.col("y"), F.lit(x), F.lit(y))
    return with_lv03_anywhere(df).withColumn("distance_m", distance).drop("x", "y")


def _walked(points: DataFrame, min_distance_m: float, slice_seconds: int) -> DataFrame:
    """Rows with the distance from the vehicle's previous row, the number of counted moves so
    far and whether the row is the vehicle's first. Windows hold one time slice of a vehicle;
    its last position and number of moves are carried to the next."""
    keys = ["id", "slice"]
    in_slice = W.partitionBy(*keys).orderBy(*ORDER)
    so_far = in_slice.rowsBetween(W.unboundedPreceding, W.currentRow)

    def counted(step: str):
        return F.coalesce((F.col(step) >= min_distance_m) & (F.col(step) > 0), F.lit(False)).cast("int")

    rows = (with_lv03_anywhere(points).withColumn("slice", time_slice(F.col("time_airflow"), slice_seconds)))
    walked = (rows.withColumn("before", F.lag(F.struct("x", "y")).over(in_slice))
              .withColumn("pos", F.row_number().over(in_slice))
              .withColumn("step", planar_distance(F.col("before.x"), F.col("before.y"), F.col("x"), F.col("y")))
              .withColumn("run", F.sum(counted("step")).over(so_far)))
    ordered = F.struct(*ORDER, "x", "y")
    slices = walked.groupBy(*keys).agg(
        F.min(ordered).alias("head"), F.max(ordered).alias("tail"), F.max("run").alias("moves"))
    by_slice = W.partitionBy("id").orderBy("slice")
    carry = (slices.withColumn("before", F.lag("tail").over(by_slice))
             .withColumn("head_step", planar_distance(
                 F.col("before.x"), F.col("before.y"), F.col("head.x"), F.col("head.y")))
             .withColumn("entry", counted("head_step"))
             .select(*keys, "head_step", F.col("before").isNull().alias("opens"),
                     (F.coalesce(F.sum(F.col("entry") + F.col("moves")).over(
                         by_slice.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
                      + F.col("entry")).alias("base")))
    head = F.col("pos") == 1
    return (walked.join(carry, keys)
            .withColumn("distance_m", F.when(head, F.col("head_step")).otherwise(F.col("step")))
            .withColumn("_rank", F.col("base") + F.col("run") + 1)
            .withColumn("_first", head & F.col("opens"))
            .drop("slice", "x", "y", "before", "pos", "step", "run", "head_step", "opens", "base"))


def distance_from_last_row(points: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add ``distance_m`` from the vehicle's previous row; null for its first."""
    return _walked(points, 0.0, slice_seconds).drop("_rank", "_first")


def moved_datapoints(points: DataFrame, min_distance_m: float = 20.0, debug: bool = False,
                     slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Rows at least ``min_distance_m`` from the vehicle's previous row, and its first row.

    ``time_from``, ``time_to`` and ``stay_in_pos_sec`` span the rows up to the next move.
    """
    rows = _walked(points, min_distance_m, slice_seconds)
    ordered = F.struct(*ORDER)
    spans = rows.groupBy("id", "_rank").agg(
        F.min(ordered).alias("head"), F.max(ordered).alias("tail")).select(
        "id", "_rank", F.col("head.time_provider").alias("time_from"), F.col("tail.time_provider").alias("time_to"))
    kept = rows.where((F.col("distance_m") >= min_distance_m) | F.col("_first"))
    result = kept.join(spans, ["id", "_rank"]).withColumn(
        "stay_in_pos_sec", seconds_between(F.col("time_from"), F.col("time_to")))
    return result if debug else result.select([c for c in result.columns if not c.startswith("_")])
