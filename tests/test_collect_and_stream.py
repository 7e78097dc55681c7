"""Collection files, streaming jobs and the interval job."""

import datetime as dt
import json

import pytest
from conftest import TRACK
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from curbline import schema
from curbline.functions.timing import Interval, ts
from curbline.operators import stats
from curbline.plans.collect import enrich
from curbline.plans.interval_job import BackfillFailed, Job, backfill, days, session_job
from curbline.sources import feeds
from curbline.sources.observations import read_observations, scan_sightings, scan_status
from curbline.sources.warehouse import Warehouse, append_observations
from curbline.streaming import jobs

RUN = "2023-01-01 10:00:00"


def vehicle(number, provider="bolt", lon=8.70, lat=47.49):
    return {"id": f"{provider}:{number}", "geometry": {"coordinates": [lon, lat]},
            "properties": {"id": f"in-{number}", "available": True,
                           "provider": {"id": provider, "name": provider.title(), "apps": {"ios": "x"}},
                           "vehicle": {"status": {"disabled": False, "reserved": False}}}}


@pytest.fixture
def landed(tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p1.json").write_text(json.dumps([vehicle(1), vehicle(2)], indent=1))
    (pages / "p2.json").write_text(json.dumps([vehicle(3, "voi"), vehicle(4, "cars")], indent=1))
    (pages / "p3.json").write_text("[]")
    (pages / "p4.json").write_text("<html>no json</html>")
    feed = tmp_path / "providers.json"
    feed.write_text(json.dumps([
        {"provider_id": "bolt", "vehicle_type": ["E-Scooter"], "last_updated": 1672567200},
        {"provider_id": "voi", "vehicle_type": ["Bike", "E-Scooter"], "last_updated": 1672567260},
        {"provider_id": "cars", "vehicle_type": ["E-Car"], "last_updated": 1672567260},
        {"provider_id": "none", "last_updated": 1672567260}]))
    return pages, feed


def test_pages_and_feed(spark, landed):
    pages, feed = landed
    rows = feeds.read_pages(spark, str(pages))
    assert rows.count() == 4
    providers = feeds.read_provider_feed(spark, str(feed))
    assert {r.provider_id for r in feeds.offering(providers).collect()} == {"bolt", "voi"}
    got = enrich(rows, providers, ts(RUN)).orderBy("id").collect()
    assert [r.id for r in got] == ["bolt:1", "bolt:2", "voi:3"]
    assert got[2]._meta_last_updated_utc == dt.datetime(2023, 1, 1, 10, 1)
    assert "apps" not in got[0].properties.provider


def test_unknown_provider_fails(spark, landed):
    pages, feed = landed
    (pages / "p5.json").write_text(json.dumps([vehicle(5, "stranger")]))
    with pytest.raises(Exception, match="provider not in feed: stranger"):
        enrich(feeds.read_pages(spark, str(pages)), feeds.read_provider_feed(spark, str(feed)), ts(RUN)).collect()


def test_unknown_provider_fails_whatever_is_read(spark, landed):
    pages, feed = landed
    (pages / "p5.json").write_text(json.dumps([vehicle(5, "stranger")]))
    with pytest.raises(Exception, match="provider not in feed: stranger"):
        enrich(feeds.read_pages(spark, str(pages)), feeds.read_provider_feed(spark, str(feed)), ts(RUN)).count()


@pytest.mark.parametrize("order", [1, -1])
def test_odd_document_costs_only_itself(spark, tmp_path, order):
    odd = vehicle(2)
    odd["properties"]["available"] = "yes"
    (tmp_path / "p1.json").write_text(json.dumps([vehicle(1), odd][::order], indent=1))
    (tmp_path / "p2.json").write_text(json.dumps([5, None, {"geometry": None}]))
    (tmp_path / "p3.json").write_text("no json")
    (tmp_path / "p4.json").write_text("")
    got = {r.id: r.properties.available if r.properties else None for r in feeds.read_pages(spark, str(tmp_path)).collect()}
    assert got == {"bolt:1": True, "bolt:2": None, None: None}
    rejected = {r.file[-7:]: (r.no_array, r.strange_documents) for r in feeds.rejected_pages(spark, str(tmp_path)).collect()}
    assert rejected == {"p2.json": (False, 2), "p3.json": (True, 0)}


def test_latest_feed_row_counts(spark, landed):
    pages, feed = landed
    rows = json.loads(feed.read_text())
    feed.write_text(json.dumps(rows + [{**rows[0], "last_updated": 1672567500}]))
    got = enrich(feeds.read_pages(spark, str(pages)), feeds.read_provider_feed(spark, str(feed)), ts(RUN)).collect()
    assert {r.id: r._meta_last_updated_utc.minute for r in got} == {"bolt:1": 5, "bolt:2": 5, "voi:3": 1}


def test_streamed_collection(spark, landed, tmp_path):
    """The feed is read anew in every batch: a later refresh, and a provider that was not there."""
    pages, feed = landed
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "1.json").write_text(feed.read_text())
    sink, state = str(tmp_path / "obs"), str(tmp_path / "state")
    query = jobs.collect(spark, str(pages), str(folder), sink, state)
    try:
        query.processAllAvailable()
        (folder / "2.json").write_text(json.dumps([
            {"provider_id": "bolt", "vehicle_type": ["E-Scooter"], "last_updated": 1672567500},
            {"provider_id": "new", "vehicle_type": ["E-Scooter"], "last_updated": 1672567560}]))
        (pages / "p6.json").write_text(json.dumps([vehicle(6), vehicle(7, "new")]))
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.id: r._meta_last_updated_utc.minute for r in read_observations(spark, sink).collect()}
    assert got == {"bolt:1": 0, "bolt:2": 0, "voi:3": 1, "bolt:6": 5, "new:7": 6}


def test_repeated_batch_replaces_its_part(spark, tmp_path):
    table = str(tmp_path / "obs")
    for _ in range(2):
        append_observations(track_documents(spark), table, "query-0")
    append_observations(track_documents(spark), table)
    assert read_observations(spark, table).count() == 2 * track_documents(spark).count()


def track_documents(spark, days_=("2023-01-01",), vehicles=("bolt:1", "bolt:2")):
    rows = []
    for d, day in enumerate(days_):
        for n, vehicle_id in enumerate(vehicles):
            for time, lon, lat in TRACK:
                at = dt.datetime.fromisoformat(f"{day} {time}")
                rows.append((vehicle_id, {"coordinates": [lon + 0.004 * d * (n + 1), lat]},
                             {"id": f"in-{vehicle_id}", "available": True,
                              "provider": {"id": "bolt", "name": "Bolt", "apps": None},
                              "vehicle": {"status": {"disabled": n == 0, "reserved": None}}},
                             at + dt.timedelta(seconds=10), at))
    return spark.createDataFrame(rows, schema.OBSERVATION_DDL)


def test_streamed_statistics_equal_batch(spark, tmp_path):
    table = str(tmp_path / "obs")
    append_observations(track_documents(spark), table)
    store = Warehouse(spark, str(tmp_path / "store"))

    def stream():
        jobs.provider_stats(jobs.stream_observations(spark, table, 1), lambda s: read_observations(s, table), store,
                            str(tmp_path / "state"), available_now=True).awaitTermination()

    append_observations(track_documents(spark, ("2023-01-02",)), table)
    stream()
    # Rows of a day that is long over mend its bins.
    append_observations(track_documents(spark, vehicles=("bolt:3",)), table)
    stream()
    batch = stats.provider_stats(scan_status(read_observations(spark, table)))
    got = sorted(map(tuple, store.read(schema.PROVIDER_STATS).collect()))
    assert got == sorted(map(tuple, batch.collect())) and {r[4] for r in got} == {2, 3}


def test_settled_bins_are_written_once(spark, tmp_path):
    """Late rows count while their bin is open, repeats count once, rows behind a written bin are dropped."""
    table, sink = str(tmp_path / "obs"), str(tmp_path / "sink")
    base = dt.datetime(2023, 1, 1, 10)
    # Batches of (vehicle, minutes after ten).
    batches = [[("a", 0), ("b", 1), ("a", 0)], [("c", 9), ("d", 1), ("b", 1)], [("e", 30)], [("late", 1), ("f", 25)], [("g", 60)]]
    for batch in batches:
        rows = [(f"s-{v}", {"coordinates": [8.73, 47.5]},
                 {"id": v, "available": True, "provider": {"id": "bolt", "name": "Bolt", "apps": None},
                  "vehicle": {"status": {"disabled": False, "reserved": False}}},
                 base + dt.timedelta(minutes=m), base) for v, m in batch]
        append_observations(spark.createDataFrame(rows, schema.OBSERVATION_DDL), table)
        jobs.settled_counts(jobs.stream_observations(spark, table), sink, str(tmp_path / "state"), available_now=True).awaitTermination()
    found = {(int((r.time - base).total_seconds()) // 60, r.count_datapoints) for r in spark.read.parquet(sink).collect()}
    assert found == {(0, 3), (8, 1), (24, 1), (30, 1)} and spark.read.parquet(sink).count() == 4


def test_streamed_registry_equals_batch(spark, tmp_path):
    table, store = str(tmp_path / "obs"), Warehouse(spark, str(tmp_path / "store"))
    append_observations(track_documents(spark), table)
    append_observations(track_documents(spark, ("2023-01-02",)), table)
    jobs.registry(jobs.stream_observations(spark, table, files_per_batch=1), store, str(tmp_path / "state"),
                  available_now=True).awaitTermination()
    batch = stats.one_row_per_vehicle(stats.registry(scan_sightings(read_observations(spark, table))))
    assert sorted(map(tuple, store.read(schema.IDS).collect())) == sorted(map(tuple, batch.collect()))


def test_interval_job(spark, streets, tmp_path):
    observations = track_documents(spark, ("2023-01-01", "2023-01-02"))
    first, second = (Warehouse(spark, str(tmp_path / n)) for n in ("one", "two"))
    job = Job(observations, *streets, [first, second])
    report = backfill(job, "2023-01-01 00:05:00", "2023-01-03 00:05:00")
    assert [set(s.values()) for s in report.values()] == [{"done"}, {"done"}]
    path = first.read(schema.PATH)
    # Three moves on the first day; on the second the trip back to the start as well.
    assert {d.day: n for d, n in path.groupBy(F.to_date("time_from")).count().collect()} == {1: 6, 2: 8}
    assert first.read(schema.IDS).agg(F.sum("datapoints")).first()[0] == 32
    assert first.read(schema.MART_DISTINCT_IDS).count() == 2
    assert first.read(schema.MART_EDGES).count() == path.agg(F.sum(F.size("path_walk_since_last"))).first()[0]
    before = {t.name: sorted(map(str, first.read(t).collect())) for t in schema.TABLES}
    assert before == {t.name: sorted(map(str, second.read(t).collect())) for t in schema.TABLES}
    again = job.run(days("2023-01-02 00:05:00", "2023-01-03 00:05:00")[0])
    assert set(again.values()) == {"done"}
    assert before == {t.name: sorted(map(str, first.read(t).collect())) for t in schema.TABLES}


def test_day_without_rows(spark, streets, tmp_path):
    """A quiet day is skipped, and the day after it is run."""
    store = Warehouse(spark, str(tmp_path / "store"))
    job = Job(track_documents(spark, ("2023-01-01", "2023-01-03")), *streets, [store])
    report = backfill(job, "2023-01-01 00:05:00", "2023-01-04 00:05:00")
    assert [set(s.values()) for s in report.values()] == [{"done"}, {"skipped"}, {"done"}]
    assert {d.day for (d,) in store.read(schema.PATH).select(F.to_date("time_from")).distinct().collect()} >= {1, 3}


def test_failed_day_is_raised_at_the_end(spark, streets, tmp_path, monkeypatch):
    job = Job(track_documents(spark), *streets, [Warehouse(spark, str(tmp_path / "store"))])
    ran = []

    def run(interval):
        ran.append(interval.start.day)
        if interval.start.day == 1:
            raise ValueError("no good")
        return {"path": "done"}
    monkeypatch.setattr(job, "run", run)
    with pytest.raises(BackfillFailed, match="2023-01-01") as failure:
        backfill(job, "2023-01-01", "2023-01-03")
    assert ran == [1, 2] and [s.get("failed") for s in failure.value.report.values()] == ["no good", None]


def test_later_days_run_after_a_spark_error(monkeypatch):
    def run(self, interval):
        if interval.start.day == 1:
            raise PySparkException("lost")
        return {"path": "done"}
    monkeypatch.setattr(Job, "run", run)
    with pytest.raises(BackfillFailed) as failed:
        backfill(Job(None, None, None, []), "2024-01-01", "2024-01-03")
    assert ["failed" in status for status in failed.value.report.values()] == [True, False]


def test_job_over_stored_tables(spark, streets, tmp_path):
    append_observations(track_documents(spark), str(tmp_path / "obs"))
    for name, df in zip(("nodes", "edges"), streets):
        df.write.parquet(str(tmp_path / name))
    job = session_job(spark, *(str(tmp_path / n) for n in ("obs", "nodes", "edges", "store")))
    assert set(job.run(Interval.of("2023-01-01", "2023-01-02")).values()) == {"done"}
    assert job.targets[0].read(schema.PATH).count() == 6
