"""Parquet tables with keyed upserts.

A table is partitioned by a column derived from its rows, so that an upsert reads and rewrites
only the partitions its updates touch. Every change is one commit (``snapshots``): readers see
all of it or nothing, and a run that dies can be repeated. Tables that add up over runs keep the
rows of every run, told apart by ``part``, and are added up when read; their folders are merged
into larger ones level by level.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions.timing import day
from curbline.operators import merge, stats
from curbline.schema import TABLES, Table
from curbline.session import stage
from curbline.sources.snapshots import Entry, Snapshots

# So many folders of one level of a table that adds up are merged into one of the next level.
FAN = 8


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, fan: int = FAN):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fan = fan

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def snapshots(self, table: Table) -> Snapshots:
        return Snapshots(self.spark, self.path(table))

    def create(self, *tables: Table) -> None:
        """Create the tables that do not exist yet, empty."""
        for table in tables or TABLES:
            versions = self.snapshots(table)
            if not versions.exists():
                # Another writer may have been faster, then its version stays.
                versions.commit(lambda entries: None if versions.exists() else entries)

    def _full_ddl(self, table: Table) -> str:
        name, expression = table.partition
        kind = "date" if expression.startswith("to_date") else "string" if table.in_parts else "bigint"
        return f"{table.ddl}, {name} {kind}"

    def _with_partition(self, table: Table, df: DataFrame) -> DataFrame:
        name, expression = table.partition
        return df.select(*table.columns).withColumn(name, F.expr(expression))

    def _rows(self, table: Table, entries: list[Entry]) -> DataFrame:
        return self.snapshots(table).read(entries, self._full_ddl(table), not table.in_parts)

    def _stored(self, table: Table) -> DataFrame:
        return self._rows(table, self.snapshots(table).current()[1])

    def read(self, table: Table, first: dt.datetime | None = None, last: dt.datetime | None = None) -> DataFrame:
        """The rows of a table; of one partitioned by day only the days from ``first`` to
        ``last``, both in."""
        df = self._stored(table)
        if table.in_parts:
            return stats.one_row_per_vehicle(df.select(*table.columns))
        if first is not None:
            df = df.where(F.col(table.partition[0]) >= day(first))
        if last is not None:
            df = df.where(F.col(table.partition[0]) <= day(last))
        return df.drop(table.partition[0])

    def _put(self, table: Table, df: DataFrame) -> list[Entry]:
        name, _ = table.partition
        order = [c for c in ("city_bfs_id", "id", "time_from", "time") if c in table.columns]
        return self.snapshots(table).put(df.hint("rebalance", F.col(name)).sortWithinPartitions(name, *order), name)

    def _put_parts(self, table: Table, df: DataFrame, parts: tuple[str, ...], level: int = 0) -> list[Entry]:
        return self.snapshots(table).put(df.hint("rebalance"), None, level, parts)

    def upsert(self, table: Table, updates: DataFrame) -> None:
        """Merge ``updates`` into the table: stored rows they replace go.

        Updates are written once, to the folder they stay in; of the stored rows of the partitions they
        touch, those that stay are written beside them.
        """
        if table.in_parts:
            raise ValueError(f"{table.name} adds up: use contribute")
        self.create(table)
        name, _ = table.partition
        added = self._put(table, self._with_partition(table, updates))
        rows = self._rows(table, added)
        try:
            merge.assert_unique(rows, table.key)
        except ValueError:
            self.snapshots(table).discard(added)
            raise
        # One value per touched day, region or bucket.
        touched = [r[0] for r in rows.select(name).distinct().collect()]

        def change(entries: list[Entry]) -> list[Entry]:
            rest = _rest(entries, name, touched)
            if rest != entries:
                current = self._rows(table, entries).where(F.col(name).isin(touched))
                rest = rest + self._put(table, merge.unreplaced(current, rows, table.replaces or table.key))
            return rest + added

        if touched:
            self.snapshots(table).commit(change)

    def delete_older(self, table: Table, column: str, delete_before: dt.date | str,
                     city_bfs_id: int | None = None) -> None:
        """Delete rows by date of ``column``; partitions left without rows are removed. A row
        that is a sum goes with all that was added up for it."""
        name, _ = table.partition
        gone = merge.expired(column, delete_before, city_bfs_id)

        def change(entries: list[Entry]) -> list[Entry] | None:
            stored = self._rows(table, entries)
            touched = [r[0] for r in stored.where(gone).select(name).distinct().collect()]
            if not touched:
                return None
            kept = merge.retain(stored.where(F.col(name).isin(touched)), column, delete_before, city_bfs_id)
            return _rest(entries, name, touched) + self._put(table, kept)

        def change_parts(entries: list[Entry]) -> list[Entry] | None:
            stored = self._rows(table, entries)
            keys = list(table.key)
            sums = stats.one_row_per_vehicle(stored.select(*table.columns))
            expired = stage(sums.where(gone).select(*keys), f"expired-{table.name}")
            touched = {r[0] for r in stored.join(expired, keys, "left_semi").select(name).distinct().collect()}
            hit = [e for e in entries if touched & set(e.values)]
            if not hit:
                return None
            kept = self._rows(table, hit).join(expired, keys, "left_anti").select(*stored.columns)
            parts = tuple(v for e in hit for v in e.values)
            return [e for e in entries if e not in hit] + self._put_parts(table, kept, parts, max(e.level for e in hit))

        self.snapshots(table).commit(change_parts if table.in_parts else change)

    def contribute(self, table: Table, rows: DataFrame, part: str) -> None:
        """Set what the named run contributes to a table that adds up.

        A repeat of the run replaces its own part and no other, whatever ran in between, so
        nothing is counted twice and nothing of other runs is lost.
        """
        if not re.fullmatch(r"[\w.-]+", part):
            raise ValueError(f"no name for a part: {part!r}")
        self.create(table)
        staged = stage(rows.select(*table.columns), f"part-{table.name}")
        merge.assert_unique(staged, table.key)

        def change(entries: list[Entry]) -> list[Entry]:
            after = self._put_parts(table, staged.withColumn("part", F.lit(part)), (part,))
            for entry in entries:
                left = tuple(v for v in entry.values if v != part)
                if left == entry.values:
                    after.append(entry)
                elif left:
                    # A merged folder that covers the part is written again without it.
                    rows = self._rows(table, [entry]).where(F.col("part") != part)
                    after += self._put_parts(table, rows, left, entry.level)
            return after

        self.snapshots(table).commit(change)
        self.compact(table)

    def compact(self, table: Table) -> None:
        """Merge folders of a table that adds up while a level holds ``fan`` of them.

        Rows keep their part, so a repeat of a merged part still finds its rows. What is committed
        before a merge stands whether or not the merge succeeds.
        """
        def change(entries: list[Entry]) -> list[Entry] | None:
            for level in sorted({e.level for e in entries}):
                full = [e for e in entries if e.level == level]
                if len(full) >= self.fan:
                    merged = self._put_parts(table, self._rows(table, full), tuple(v for e in full for v in e.values), level + 1)
                    return [e for e in entries if e not in full] + merged
            return None

        versions = self.snapshots(table)
        while len(versions.current()[1]) >= self.fan:
            before = versions.current()[0]
            versions.commit(change)
            if versions.current()[0] == before:
                return


def _rest(entries: list[Entry], name: str, touched: list) -> list[Entry]:
    """The entries without the touched partitions."""
    gone = {f"{name}={value}" for value in touched}
    return [e for e in (entry.without(gone) for entry in entries) if e]


def append_observations(observations: DataFrame, path: str, part: str | None = None) -> None:
    """Append documents, with the top-level columns that later scans prune by.

    With ``part``, a repeat of the same part replaces it instead of adding its rows again.
    """
    folder = f"{path}/part={part or uuid.uuid4().hex}"
    (with_scan_columns(observations).hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date")
     .parquet(folder))


def with_scan_columns(observations: DataFrame) -> DataFrame:
    at = F.col("geometry.coordinates")
    return observations.withColumns({
        "lon": at[0], "lat": at[1], "date": F.to_date("_meta_runtime_utc")})
