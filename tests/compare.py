"""Run queries against their SQL counterparts and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(got, expected):
    """None when (columns, rows) are equal, else a short description."""
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if got[1] == expected[1]:
        return None
    extra, missing = sorted(set(got[1]) - set(expected[1])), sorted(set(expected[1]) - set(got[1]))
    return (f"{len(got[1])} rows, expected {len(expected[1])}; {len(extra)} extra, {len(missing)} missing; "
            f"{got[0]}: extra {extra[:2]} missing {missing[:2]}")


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from curbline.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles, failed = connection(sf_dir), entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                got = spark_rows(df)
                spent, start = time.time() - start, time.time()
                problem = difference(got, sql_rows(con, oracles[name]))
                note = f"{len(got[1])} rows, sql {time.time() - start:.1f}s"
            else:
                problem, note = None, f"{df.count()} rows, no sql"
                spent = time.time() - start
        except Exception as error:  # noqa: BLE001
            problem, note, spent = f"{type(error).__name__}: {str(error)[:600]}", "", time.time() - start
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {spent:.1f}s {note} {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
