"""Expectations on results."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.timing import Interval

# Path columns that must never be null.
REQUIRED_PATH_COLUMNS = ("id", "provider", "point", "distance_m", "moving", "time_from", "time_to")

log = logging.getLogger(__name__)


class Skip(Exception):
    """A step has nothing to do; it is reported as skipped, not failed."""


def not_null_report(df: DataFrame, columns: Sequence[str] = REQUIRED_PATH_COLUMNS) -> DataFrame:
    """Null and total rows per column, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{c}").alias("null_rows"), F.col("rows").alias("total_rows"))
        for c in columns])))


def assert_not_null(df: DataFrame, columns: Sequence[str] = REQUIRED_PATH_COLUMNS) -> None:
    broken = {r["column_name"]: r["null_rows"] for r in not_null_report(df, columns).where("null_rows > 0").collect()}
    if broken:
        raise ValueError(f"null values in required columns: {broken}")


def rows_in_interval(path: DataFrame, interval: Interval) -> DataFrame:
    """Rows per region whose ``time_to`` lies in the interval, both ends included."""
    return (path.where(interval.covers(F.col("time_to")))
            .groupBy("city_bfs_id").agg(F.count(F.lit(1)).alias("path_rows")))


def assert_rows(path: DataFrame, interval: Interval, fail: bool = False) -> bool:
    """Whether any path row ends in the interval; without one, warn or fail."""
    if not path.where(interval.covers(F.col("time_to"))).isEmpty():
        return True
    message = f"no path rows between {interval.start} and {interval.end}"
    if fail:
        raise ValueError(message)
    log.warning(message)
    return False


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise Skip(f"no {what}")
