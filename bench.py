"""Wall seconds of every query at one scale, in one session; prints one JSON line.

Results are consumed in full by a sink that discards them. A short run of one query on the
smallest scale starts the session first; after that each query runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from curbline.plans.catalog import catalog  # noqa: E402
from curbline.session import build_session  # noqa: E402


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(queries)
    warm = Path(sf_dir).parent / "sf0.001"
    if warm.exists():
        run(queries["provider_stats"], spark, str(warm))
    seconds = {}
    for name in wanted:
        seconds[name] = round(run(queries[name], spark, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_wall", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
