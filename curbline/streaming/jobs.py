"""Streaming jobs. Each returns a started query. All but ``settled_counts`` keep no state but their read
offsets: a micro-batch is written under keys or names that a repeat writes again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbline import schema
from curbline.operators import stats
from curbline.plans.collect import enrich
from curbline.regions import REGIONS, Region
from curbline.session import broadcast_if_small, scratch_run, stage
from curbline.sources.feeds import read_provider_feed, stream_pages
from curbline.sources.observations import LANDED_DDL, scan_sightings, scan_status
from curbline.sources.warehouse import Warehouse, append_observations

# A broadcast bin takes about this many bytes in a hash relation.
BIN_BYTES = 60


def stream_observations(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The landed observation table as a stream."""
    return (spark.readStream.schema(LANDED_DDL).option("maxFilesPerTrigger", files_per_batch).parquet(path).drop("part"))


def _start(rows: DataFrame, apply: Callable[[DataFrame, str], None], checkpoint: str, available_now: bool,
           every: str) -> StreamingQuery:
    """Run ``apply`` on every micro-batch with a name that a repeat of the batch gets again: the
    identity that the checkpoint keeps for its query, and the batch number."""

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        with scratch_run(session):
            apply(batch, f"{query}-{number}")

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def collect(spark: SparkSession, pages: str, feed: str, sink: str, checkpoint: str,
            available_now: bool = False) -> StreamingQuery:
    """Landed page files to the observation table, each file once. The provider feed is read
    from its path anew for every micro-batch, so refresh times and new providers are seen."""

    def apply(batch: DataFrame, name: str) -> None:
        session = batch.sparkSession
        rows = enrich(batch, read_provider_feed(session, feed), F.current_timestamp())
        append_observations(rows, sink, name)

    return _start(stream_pages(spark, pages), apply, checkpoint, available_now, "2 minutes")


def provider_stats(observations: DataFrame, stored: Callable[[SparkSession], DataFrame], target: Warehouse,
                   checkpoint: str, regions: Sequence[Region] = REGIONS, available_now: bool = False) -> StreamingQuery:
    """Two-minute provider statistics: the bins that a micro-batch has rows in are computed
    again from the ``stored`` table the stream reads, and upserted.

    There is no watermark: a bin is written when its first rows come and mended by late ones.
    A batch reads the stored days it touches, not the whole table.
    """

    def apply(batch: DataFrame, name: str) -> None:
        session = batch.sparkSession
        at = F.col("_meta_runtime_utc")
        bins = stage(batch.select(F.window(at, stats.BIN).start.alias("bin")).where("bin IS NOT NULL").distinct(), "bins")
        # One value per touched day.
        days = [r[0] for r in bins.select(F.to_date("bin")).distinct().collect()]
        rows = stored(session)
        if "date" in rows.columns:
            rows = rows.where(F.col("date").isin(days))
        touched = (rows.withColumn("bin", F.window(at, stats.BIN).start)
                   .join(broadcast_if_small(bins, BIN_BYTES), "bin", "left_semi").drop("bin"))
        Warehouse(session, target.root).upsert(
            schema.PROVIDER_STATS, stats.provider_stats(scan_status(touched, None, regions)))

    return _start(observations, apply, checkpoint, available_now, "2 minutes")


def registry(observations: DataFrame, target: Warehouse, checkpoint: str, regions: Sequence[Region] = REGIONS,
             available_now: bool = False, every: str = "1 hour") -> StreamingQuery:
    """Add each micro-batch to the registry as a part of its own. Parts are added up when the
    registry is read, so batches are large by default."""

    def apply(batch: DataFrame, name: str) -> None:
        rows = stats.one_row_per_vehicle(stats.registry(scan_sightings(batch, None, regions)))
        Warehouse(batch.sparkSession, target.root).contribute(schema.IDS, rows, name)

    return _start(observations, apply, checkpoint, available_now, every)


def settled_counts(observations: DataFrame, sink: str, checkpoint: str, late: str = "10 minutes",
                   regions: Sequence[Region] = REGIONS, available_now: bool = False) -> StreamingQuery:
    """Two-minute bins that are written once, when no row of theirs can come any more.

    Beside the keyed repair of ``provider_stats``, for sinks that only take new rows: a vehicle's repeated
    collection counts once, rows up to ``late`` behind the newest one still count, rows of a bin that was
    written are dropped. State holds the bins and keys of that time only.
    """
    keys = ["id", "provider", "city_bfs_id", "runtime"]
    once = scan_status(observations, None, regions).withWatermark("runtime", late).dropDuplicatesWithinWatermark(keys)
    bins = once.groupBy("provider", "city_bfs_id", F.window("runtime", stats.BIN).alias("bin")).agg(
        F.count(F.lit(1)).alias("count_datapoints"), F.sum("available").alias("count_available"))
    rows = bins.select(F.col("bin.start").alias("time"), "provider", "city_bfs_id", "count_datapoints", "count_available")
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="2 minutes")).start(sink)
