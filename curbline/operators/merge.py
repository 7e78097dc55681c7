"""Keyed merges and retention as pure DataFrame functions.

Keys are unique on both sides, so the joins below hash evenly whatever a vehicle's share
of the rows is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not updated, and all ``updates``."""
    return unreplaced(target, updates, keys).unionByName(updates.select(*target.columns))


def unreplaced(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not updated."""
    return target.join(updates.select(*keys), list(keys), "left_anti")


def accumulate(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Registry merge: provider from the update, times widened, datapoints added."""
    both = target.withColumn("_new", F.lit(0)).unionByName(
        updates.select(*target.columns).withColumn("_new", F.lit(1)))
    extra = [c for c in target.columns
             if c not in ("id", "city_bfs_id", "provider", "first_seen", "last_seen", "datapoints")]
    return both.groupBy("id", "city_bfs_id", *extra).agg(
        F.max(F.struct("_new", "provider")).alias("_latest"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("datapoints").alias("datapoints"),
    ).withColumn("provider", F.col("_latest.provider")).select(*target.columns)


def expired(column: str, delete_before: dt.date | str, city_bfs_id: int | None = None) -> Column:
    """Rows to delete: older by calendar date, in one region or in all."""
    old = F.to_date(F.col(column)) < F.lit(delete_before).cast("date")
    return old if city_bfs_id is None else old & (F.col("city_bfs_id") == city_bfs_id)


def retain(df: DataFrame, column: str, delete_before: dt.date | str, city_bfs_id: int | None = None) -> DataFrame:
    return df.where(~F.coalesce(expired(column, delete_before, city_bfs_id), F.lit(False)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """A merge may touch a row once only; name some offenders otherwise."""
    offenders = duplicate_keys(df, keys).limit(5).collect()
    if offenders:
        raise ValueError(f"merge source has duplicate keys {tuple(keys)}: {[tuple(r) for r in offenders]}")
