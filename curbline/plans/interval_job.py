"""The interval job over all regions, and the back-fill that runs it day by day."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from curbline import schema
from curbline.functions.timing import Interval, as_utc
from curbline.operators import marts, quality, stats
from curbline.operators.paths import build_paths
from curbline.regions import REGIONS, Region
from curbline.session import scratch_run, stage, tune
from curbline.sources import observations as scans
from curbline.sources.streets import clip_edges, clip_nodes
from curbline.sources.warehouse import Warehouse

log = logging.getLogger(__name__)


@dataclass
class Job:
    """Inputs and targets. Results are computed once and written to every target; reads of
    stored paths use the first."""

    observations: DataFrame
    street_nodes: DataFrame
    street_edges: DataFrame
    targets: Sequence[Warehouse]
    regions: Sequence[Region] = REGIONS
    status: dict[str, str] = field(default_factory=dict)

    def _step(self, name: str, work: Callable[[], None]) -> None:
        try:
            work()
            self.status[name] = "done"
        except quality.Skip as why:
            log.info("%s skipped: %s", name, why)
            self.status[name] = "skipped"

    def _write(self, table: schema.Table, result: DataFrame) -> None:
        rows = stage(result, f"result-{table.name}")
        for target in self.targets:
            target.upsert(table, rows)

    def run(self, interval: Interval) -> dict[str, str]:
        """Three ETLs, the row assertion, four marts. Steps without input are skipped."""
        spark = tune(self.targets[0].spark)
        self.status = {}
        for target in self.targets:
            target.create()
        with scratch_run(spark):
            self._steps(interval)
        return self.status

    def _steps(self, interval: Interval) -> None:
        self._step("path", lambda: self._paths(interval))
        self._step("provider_stats", lambda: self._provider_stats(interval))
        self._step("ids", lambda: self._registry(interval))
        if self.status["path"] == "skipped":
            self.status |= dict.fromkeys(
                ("path_rows", "mart_edges", "mart_distinct_ids", "mart_scooter_age", "mart_trip_distance"), "skipped")
            return
        store = self.targets[0]
        path = store.read(schema.PATH, last=interval.end)
        self._step("path_rows", lambda: quality.assert_rows(path, interval, fail=True))
        self._step("mart_edges", lambda: self._write(schema.MART_EDGES, marts.edges(
            store.read(schema.PATH, interval.start, interval.end), interval)))
        self._step("mart_distinct_ids", lambda: self._write(schema.MART_DISTINCT_IDS, marts.distinct_vehicles(
            store.read(schema.PATH, interval.start, interval.start), interval.start)))
        self._step("mart_scooter_age", lambda: self._write(
            schema.MART_VEHICLE_AGE, marts.vehicle_age(path, interval)))
        self._step("mart_trip_distance", lambda: self._write(
            schema.MART_TRIP_DISTANCE, marts.one_row_per_trip(marts.trip_distance(path, interval))))

    def _paths(self, interval: Interval) -> None:
        points = scans.scan_points(self.observations, interval, self.regions)
        quality.require_rows(points, "observations")
        nodes = clip_nodes(self.street_nodes, self.regions)
        rows = stage(build_paths(points, nodes, clip_edges(self.street_edges, nodes), interval,
                                 self.targets[0].read(schema.PATH, last=interval.start), self.regions), "paths")
        quality.require_rows(rows, "movement")
        quality.assert_not_null(rows)
        self._write(schema.PATH, rows)

    def _provider_stats(self, interval: Interval) -> None:
        status = scans.scan_status(self.observations, interval, self.regions)
        quality.require_rows(status, "observations")
        self._write(schema.PROVIDER_STATS, stats.provider_stats(status))

    def _registry(self, interval: Interval) -> None:
        """Adds up over intervals; a repeat of an interval replaces what it added."""
        sightings = scans.scan_sightings(self.observations, interval, self.regions)
        quality.require_rows(sightings, "observations")
        rows = stage(stats.one_row_per_vehicle(stats.registry(sightings)), "registry")
        for target in self.targets:
            target.contribute(schema.IDS, rows, f"{interval.start:%Y%m%dT%H%M%S}-{interval.end:%Y%m%dT%H%M%S}")


def days(first: dt.datetime | str, last: dt.datetime | str) -> list[Interval]:
    """Day intervals from ``first`` up to ``last``, oldest first; they start at ``first``'s time."""
    start, stop = as_utc(first), as_utc(last)
    result = []
    while start < stop:
        result.append(Interval(start, start + dt.timedelta(days=1)))
        start += dt.timedelta(days=1)
    return result


class BackfillFailed(RuntimeError):
    """Some days failed; ``report`` tells what every day did."""

    def __init__(self, report: dict[str, dict[str, str]]):
        super().__init__(f"failed days: {[d for d, status in report.items() if 'failed' in status]}")
        self.report = report


def backfill(job: Job, first: dt.datetime | str, last: dt.datetime | str) -> dict[str, dict[str, str]]:
    """Run the job once per day in order: each day is stitched to the stays of the days before.

    A quiet day is skipped. A day that fails does not keep later ones from running; at the
    end the failures are raised with the report of all days.
    """
    report = {}
    for interval in days(first, last):
        try:
            report[interval.start.isoformat()] = job.run(interval)
        except (ValueError, PySparkException) as why:
            log.warning("%s failed: %s", interval.start, why)
            report[interval.start.isoformat()] = {**job.status, "failed": str(why)}
    if any("failed" in status for status in report.values()):
        raise BackfillFailed(report)
    return report


def session_job(spark: SparkSession, observations: str, nodes: str, edges: str, *targets: str) -> Job:
    """A job over stored tables, given by their paths."""
    from curbline.sources.streets import read_street_edges, read_street_nodes
    return Job(scans.read_observations(spark, observations), read_street_nodes(spark, nodes),
               read_street_edges(spark, edges), [Warehouse(spark, t) for t in targets])
