"""Session settings and shared scratch space."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 1000
_LOCAL_SCRATCH: dict[str, str] = {}
_RUN: ContextVar[str] = ContextVar("curbline_run", default="shared")

# Largest estimated size of a table that is sent to every executor.
BROADCAST_LIMIT_BYTES = 256 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings every job here relies on; all may be changed on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Joins whose partitions all turn out small skip the sort; others still sort and merge.
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    return spark


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python ``ARROW_ROWS`` at a time; a session that sends fewer is left as it is.

    An executor holds a batch several times for each task: as it is filled, as it is sent, and as it is
    read in the worker. With Spark's 10,000 rows of text that is most of what it takes beside the heap.
    """
    rows = int(spark.conf.get(ARROW_ROWS_KEY))
    if not 0 < rows <= ARROW_ROWS:
        spark.conf.set(ARROW_ROWS_KEY, str(ARROW_ROWS))


def build_session(name: str = "curbline", master: str | None = None, **conf: str) -> SparkSession:
    # The route search generates more classes than the default code cache keeps.
    builder = (SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.codegen.cache.maxEntries", "2000"))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for local masters."""
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="curbline-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/curbline/{_RUN.get()}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Stages written inside belong to one run and are removed when it has succeeded."""
    name = f"run-{uuid.uuid4().hex}"
    token = _RUN.set(name)
    try:
        yield
    finally:
        _RUN.reset(token)
    folder, files = hadoop_path(spark, f"{scratch_root(spark)}/curbline/{name}")
    files.delete(folder, True)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` written once; what it staged on the way is removed when the result stands.

    Shuffle files of its jobs go when the driver's JVM collects their plans, which an idle
    driver may not do for long, so it is asked to.
    """
    path = scratch_path(spark, label)
    with scratch_run(spark):
        made = make()
        schema = made.schema
        made.write.parquet(path)
    del made
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int | None = None) -> DataFrame:
    """Hint a broadcast when the counted rows fit the limit; beyond it the join shuffles."""
    allowed = BROADCAST_LIMIT_BYTES if limit is None else limit
    return F.broadcast(df) if df.count() * row_bytes <= allowed else df


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Used where a result feeds several jobs: it cuts the lineage, survives the loss of
    executors, and leaves the planner real sizes to choose join strategies by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
