"""Steps that decide how the stored paths grow: rows are moved and written once."""

import datetime as dt

import pytest
from curbline.functions.geo import legs_length, line_length, point
from curbline.operators.paths import one_region_per_key
from curbline.operators.stays import STAY_BLOCK, with_previous
from curbline.schema import MART_DISTINCT_IDS
from curbline.sources.warehouse import Warehouse
from pyspark.sql import functions as F

DISTINCT = "provider string, city_bfs_id int, time timestamp, distinct_ids bigint"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_previous_stay_over_blocks_without_doubled_rows(spark):
    last = 2 * STAY_BLOCK + 3
    rows = [(230, v, n, float(n)) for v in ("a", "b") for n in range(last) if (v, n) != ("b", STAY_BLOCK)]
    got = with_previous(spark.createDataFrame(rows, "city_bfs_id int, id string, stay bigint, lon double"), ["lon"])
    assert "Aggregate" not in _plan(got)
    found = {(r.id, r.stay): r.previous and r.previous.lon for r in got.collect()}
    there = {(v, n) for _, v, n, _ in rows}
    assert found == {(v, n): float(n - 1) if (v, n - 1) in there else None for v, n in there}


def test_last_region_keeps_the_row_in_one_move(spark):
    at = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([("a", at, 230, 1.0), ("a", at, 351, 0.0), ("a", at, 230, 2.0), ("b", at, 261, None), (None, None, 230, 5.0)],
                                 "id string, time_from timestamp, city_bfs_id int, lon double")
    got = one_region_per_key(rows)
    assert "Aggregate" not in _plan(got)
    assert sorted((str(r.id), r.city_bfs_id, r.lon) for r in got.collect()) == [("None", 230, 5.0), ("a", 351, 0.0), ("b", 261, None)]


def test_legs_add_up_to_the_line(spark):
    rows = spark.createDataFrame([(8.7, 47.49, 8.71, 47.5), (8.7, 47.49, 8.7, 47.49), (8.7, None, 8.71, 47.5), (0.0, 47.0, 8.7, 47.5)],
                                 "a double, b double, c double, d double")
    legs = [(F.col("a"), F.col("b")), (F.col("a"), F.col("d")), (F.col("c"), F.col("d"))]
    got = rows.select(legs_length(legs).alias("legs"), line_length(F.array(*[point(*at) for at in legs])).alias("line")).collect()
    assert [r.legs for r in got] == [r.line for r in got] and got[0].legs > 0


def test_an_upsert_writes_its_rows_once(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    day = dt.datetime(2024, 1, 1)
    store.upsert(MART_DISTINCT_IDS, spark.createDataFrame([("p", 1, day, 1), ("q", 1, day, 2)], DISTINCT))
    first = store.snapshots(MART_DISTINCT_IDS).current()[1]
    store.upsert(MART_DISTINCT_IDS, spark.createDataFrame([("q", 1, day, 3)], DISTINCT))
    kept, added = store.snapshots(MART_DISTINCT_IDS).current()[1]
    assert kept.values == added.values == first[0].values
    ddl = f"{DISTINCT}, day date"
    versions = store.snapshots(MART_DISTINCT_IDS)
    assert [r.distinct_ids for r in versions.read([added], ddl, True).collect()] == [3]
    assert [r.distinct_ids for r in versions.read([kept], ddl, True).collect()] == [1]
    assert sorted((r.provider, r.distinct_ids) for r in store.read(MART_DISTINCT_IDS).collect()) == [("p", 1), ("q", 3)]


def test_a_refused_upsert_leaves_no_folder(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    day = dt.datetime(2024, 1, 1)
    store.upsert(MART_DISTINCT_IDS, spark.createDataFrame([("p", 1, day, 1)], DISTINCT))
    before = sorted(p.name for p in (tmp_path / "mart_distinct_ids" / "data").iterdir())
    with pytest.raises(ValueError):
        store.upsert(MART_DISTINCT_IDS, spark.createDataFrame([("q", 1, day, 2), ("q", 1, day, 3)], DISTINCT))
    store.upsert(MART_DISTINCT_IDS, spark.createDataFrame([], DISTINCT))
    assert sorted(p.name for p in (tmp_path / "mart_distinct_ids" / "data").iterdir()) == before
    assert [r.distinct_ids for r in store.read(MART_DISTINCT_IDS).collect()] == [1]
