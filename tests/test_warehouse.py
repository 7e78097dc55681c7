"""Tables, merges, retention and expectations."""

import datetime as dt
import pathlib
from collections import Counter

import pytest

from curbline import schema
from curbline.functions.timing import Interval
from curbline.operators import merge, quality, stats
from curbline.sources import snapshots
from curbline.sources import warehouse as module
from curbline.sources.warehouse import Warehouse

INTERVAL = Interval.of("2023-01-01", "2023-01-02")


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"))


def distinct_rows(spark, rows):
    """(provider, day, count)"""
    return spark.createDataFrame([(p, 230, dt.datetime(2023, 1, d), n) for p, d, n in rows], schema.MART_DISTINCT_IDS.ddl)


def ids(spark, rows):
    """(id, provider, first day, last day, datapoints)"""
    return spark.createDataFrame([(i, p, 230, dt.datetime(2023, 1, a), dt.datetime(2023, 1, b), n)
                                  for i, p, a, b, n in rows], schema.IDS.ddl)


def test_create_declares_all_tables(store):
    store.create()
    for table in schema.TABLES:
        df = store.read(table)
        assert df.columns == table.columns and df.isEmpty()
    assert [t.name for t in schema.TABLES] == [
        "path", "provider_stats", "ids", "mart_edges", "mart_distinct_ids", "mart_scooter_age", "mart_trip_distance"]


def test_create_keeps_existing_rows(spark, store):
    store.upsert(schema.MART_DISTINCT_IDS, distinct_rows(spark, [("a", 1, 5)]))
    store.create()
    assert store.read(schema.MART_DISTINCT_IDS).count() == 1


def test_upsert_replaces_and_is_repeatable(spark, store):
    table = schema.MART_DISTINCT_IDS
    store.upsert(table, distinct_rows(spark, [("a", 1, 5), ("b", 1, 6), ("a", 2, 7)]))
    for _ in range(2):
        store.upsert(table, distinct_rows(spark, [("a", 1, 50), ("c", 3, 9)]))
        got = {(r.provider, r.time.day): r.distinct_ids for r in store.read(table).collect()}
        assert got == {("a", 1): 50, ("b", 1): 6, ("a", 2): 7, ("c", 3): 9}


def test_upsert_accepts_any_column_order_and_no_rows(spark, store):
    table = schema.MART_DISTINCT_IDS
    rows = distinct_rows(spark, [("a", 1, 5)])
    store.upsert(table, rows.select("distinct_ids", "time", "provider", "city_bfs_id"))
    store.upsert(table, rows.limit(0))
    assert [r.distinct_ids for r in store.read(table).collect()] == [5]


def test_duplicate_keys_are_named(spark, store):
    with pytest.raises(ValueError, match="duplicate keys.*'a'"):
        store.upsert(schema.MART_DISTINCT_IDS, distinct_rows(spark, [("a", 1, 5), ("a", 1, 6)]))


def test_accumulate(spark):
    old = ids(spark, [("x", "p", 5, 6, 3), ("y", "p", 5, 6, 4)])
    new = ids(spark, [("x", "q", 4, 5, 2), ("z", "q", 9, 9, 1)])
    got = {r.id: (r.provider, r.first_seen.day, r.last_seen.day, r.datapoints) for r in merge.accumulate(old, new).collect()}
    assert got == {"x": ("q", 4, 6, 5), "y": ("p", 5, 6, 4), "z": ("q", 9, 9, 1)}


def test_provider_change_folds_to_one_row(spark):
    rows = stats.one_row_per_vehicle(ids(spark, [("x", "p", 1, 2, 3), ("x", "q", 2, 4, 5)])).collect()
    assert [(r.provider, r.first_seen.day, r.last_seen.day, r.datapoints) for r in rows] == [("q", 1, 4, 8)]


def test_once_only(spark, store):
    rows = ids(spark, [("x", "p", 1, 2, 3)])
    for part, total in (("first", 3), ("first", 3), ("second", 6)):
        store.contribute(schema.IDS, rows, part)
        assert [r.datapoints for r in store.read(schema.IDS).collect()] == [total]
    with pytest.raises(ValueError, match="adds up"):
        store.upsert(schema.IDS, rows)
    with pytest.raises(ValueError, match="no name"):
        store.contribute(schema.IDS, rows, "a/b")


def test_run_repeated_after_another_one(spark, store, monkeypatch):
    """A dies, B runs, A is repeated: both count, each once."""
    first, second = ids(spark, [("a", "p", 1, 2, 1)]), ids(spark, [("a", "q", 3, 4, 2), ("b", "p", 3, 3, 5)])
    original = module.merge.assert_unique

    def crash(df, keys):
        raise OSError("lost")
    monkeypatch.setattr(module.merge, "assert_unique", crash)
    with pytest.raises(OSError):
        store.contribute(schema.IDS, first, "A")
    monkeypatch.setattr(module.merge, "assert_unique", original)
    for rows, part in ((second, "B"), (first, "A"), (first, "A")):
        store.contribute(schema.IDS, rows, part)
    got = {r.id: (r.provider, r.first_seen.day, r.last_seen.day, r.datapoints) for r in store.read(schema.IDS).collect()}
    assert got == {"a": ("q", 1, 4, 3), "b": ("p", 3, 3, 5)}
    store.contribute(schema.IDS, first.limit(0), "A")
    assert {r.id: r.datapoints for r in store.read(schema.IDS).collect()} == {"a": 2, "b": 5}


def test_retention_of_sums(spark, store):
    """A vehicle goes when it was last seen too long ago, not the older parts of a living one."""
    store.contribute(schema.IDS, ids(spark, [("a", "p", 1, 2, 1), ("b", "p", 1, 2, 4)]), "one")
    store.contribute(schema.IDS, ids(spark, [("a", "p", 8, 9, 2)]), "two")
    store.delete_older(schema.IDS, "last_seen", "2023-01-05")
    assert [(r.id, r.first_seen.day, r.datapoints) for r in store.read(schema.IDS).collect()] == [("a", 1, 3)]


def test_shorter_path_leaves_no_tail(spark, store):
    def edges(*numbers):
        at = dt.datetime(2023, 1, 1)
        return spark.createDataFrame([("a", "p", 230, at, at, n, (8.7, 47.4), None, 1.0) for n in numbers], schema.MART_EDGES.ddl)
    store.upsert(schema.MART_EDGES, edges(1, 2, 3))
    store.upsert(schema.MART_EDGES, edges(1, 2))
    assert sorted(r.path_idx for r in store.read(schema.MART_EDGES).collect()) == [1, 2]


def test_scans_open_the_days_asked_for(spark, store):
    store.upsert(schema.MART_DISTINCT_IDS, distinct_rows(spark, [("a", d, d) for d in range(1, 11)]))
    df = store.read(schema.MART_DISTINCT_IDS, dt.datetime(2023, 1, 3), dt.datetime(2023, 1, 4, 12))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert len(df.inputFiles()) == 10 and sorted(r.distinct_ids for r in df.collect()) == [3, 4]


def live_folders(store, table):
    return store.snapshots(table).current()[1]


def test_reader_sees_all_of_a_commit_or_nothing(spark, store, monkeypatch):
    """Two days change; a read between the written folders and the commit sees the old days, also after a crash."""
    table = schema.MART_DISTINCT_IDS
    store.upsert(table, distinct_rows(spark, [("a", 1, 5), ("a", 2, 6), ("a", 3, 7)]))
    planned = store.read(table)
    seen, move = [], snapshots.Snapshots._move

    def between(self, number, entries):
        seen.append({r.time.day: r.distinct_ids for r in store.read(table).collect()})
        if len(seen) == 1:
            raise OSError("lost")
        return move(self, number, entries)
    monkeypatch.setattr(snapshots.Snapshots, "_move", between)
    new = distinct_rows(spark, [("a", 1, 50), ("a", 2, 60)])
    with pytest.raises(OSError):
        store.upsert(table, new)
    store.upsert(table, new)
    assert seen == [{1: 5, 2: 6, 3: 7}] * 2
    assert {r.time.day: r.distinct_ids for r in store.read(table).collect()} == {1: 50, 2: 60, 3: 7}
    # A frame planned on the version before still finds its files.
    assert sorted(r.distinct_ids for r in planned.collect()) == [5, 6, 7]


def test_two_writers_lose_nothing(spark, store, monkeypatch):
    """While one writer prepares its commit another one commits; the first starts again from that."""
    table = schema.MART_DISTINCT_IDS
    store.create(table)
    move, raced = snapshots.Snapshots._move, []

    def late(self, number, entries):
        if not raced:
            raced.append(True)
            Warehouse(spark, store.root).upsert(table, distinct_rows(spark, [("b", 1, 2), ("a", 1, 9)]))
        return move(self, number, entries)
    monkeypatch.setattr(snapshots.Snapshots, "_move", late)
    store.upsert(table, distinct_rows(spark, [("a", 1, 1)]))
    assert {r.provider: r.distinct_ids for r in store.read(table).collect()} == {"a": 1, "b": 2}


def test_an_upsert_writes_the_touched_days_only(spark, store):
    table = schema.MART_DISTINCT_IDS
    store.upsert(table, distinct_rows(spark, [("a", d, d) for d in range(1, 6)]))
    for n in range(6):
        store.upsert(table, distinct_rows(spark, [("a", 4, 40 + n)]))
    first, last = live_folders(store, table)
    assert sorted(first.values) == [f"day=2023-01-0{d}" for d in (1, 2, 3, 5)] and last.values == ("day=2023-01-04",)
    # Old versions are gone, and with them the folders only they named.
    data = pathlib.Path(store.path(table)) / "data"
    assert len(list(data.iterdir())) == 1 + snapshots.KEPT and not (data / first.folder / "day=2023-01-04").exists()
    assert sorted(r.distinct_ids for r in store.read(table).collect()) == [1, 2, 3, 5, 45]


def test_parts_are_merged_by_levels(spark, tmp_path, monkeypatch):
    """Few folders whatever the number of parts; a repeat of a merged part and a crash in a merge change nothing."""
    store, table = Warehouse(spark, str(tmp_path / "store"), fan=3), schema.IDS
    for n in range(14):
        store.contribute(table, ids(spark, [("x", "p", 1 + n, 2 + n, 1), (f"v{n}", "p", 1, 1, 5)]), f"b{n}")
    # 14 = 112 to base 3.
    assert sorted(e.level for e in live_folders(store, table)) == [0, 0, 1, 2]

    def totals():
        return {r.id: (r.first_seen.day, r.last_seen.day, r.datapoints) for r in store.read(table).collect()}
    expected = {"x": (1, 15, 14)} | {f"v{n}": (1, 1, 5) for n in range(14)}
    assert totals() == expected
    store.contribute(table, ids(spark, [("x", "p", 1, 2, 1), ("v0", "p", 1, 1, 5)]), "b0")
    assert totals() == expected
    assert sorted(v for e in live_folders(store, table) for v in e.values) == sorted(f"b{n}" for n in range(14))
    store.contribute(table, ids(spark, [("x", "p", 1, 2, 4)]), "b1")
    assert totals() == {k: v for k, v in expected.items() if k != "v1"} | {"x": (1, 15, 17)}
    before, put = totals(), Warehouse._put_parts

    def crash(self, table, df, parts, level=0):
        if level:
            raise OSError("lost")
        return put(self, table, df, parts, level)
    monkeypatch.setattr(Warehouse, "_put_parts", crash)
    failed = 0
    for n in range(14, 17):
        try:
            store.contribute(table, ids(spark, [("x", "p", 1, 2, 1)]), f"b{n}")
        except OSError:
            failed += 1
    assert failed and totals() == before | {"x": (1, 15, 20)}
    monkeypatch.undo()
    store.compact(table)
    assert totals() == before | {"x": (1, 15, 20)}
    assert all(n < 3 for n in Counter(e.level for e in live_folders(store, table)).values())


def test_other_layouts_are_not_overwritten(spark, store):
    folder = pathlib.Path(store.path(schema.MART_DISTINCT_IDS)) / "day=2023-01-01"
    folder.mkdir(parents=True)
    with pytest.raises(ValueError, match="without versions"):
        store.create(schema.MART_DISTINCT_IDS)


def test_retention(spark, store):
    table = schema.MART_DISTINCT_IDS
    store.upsert(table, distinct_rows(spark, [("a", 1, 5), ("b", 2, 6), ("a", 3, 7)]))
    store.delete_older(table, "time", "2023-01-02", 999)
    assert store.read(table).count() == 3
    store.delete_older(table, "time", "2023-01-02", 230)
    assert {r.time.day for r in store.read(table).collect()} == {2, 3}
    store.delete_older(table, "time", "2024-01-01")
    assert store.read(table).isEmpty()


def test_expectations(spark, caplog):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", 2)], "id string, n int")
    got = {r.column_name: (r.null_rows, r.total_rows) for r in quality.not_null_report(df, ("id", "n")).collect()}
    assert got == {"id": (1, 3), "n": (1, 3)}
    with pytest.raises(ValueError, match="'id': 1"):
        quality.assert_not_null(df, ("id", "n"))
    path = spark.createDataFrame([(230, dt.datetime(2023, 1, 2))], "city_bfs_id int, time_to timestamp")
    assert quality.assert_rows(path, INTERVAL, fail=True)
    later = Interval.of("2023-02-01", "2023-02-02")
    assert not quality.assert_rows(path, later)
    with pytest.raises(ValueError, match="no path rows"):
        quality.assert_rows(path, later, fail=True)
