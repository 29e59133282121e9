"""Incremental ingest, streaming deduplication and service-metric roll-up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from waymark import settings as S
from waymark.functions.times import as_instant, utc_wall
from waymark.plans.silver import valid_trips, with_zones
from waymark.session import scratch_dir
from waymark.streaming.batches import latest_rows, stream_latest

# Histogram bounds of request latency (ms) and batch size.
LATENCY_BOUNDS = (5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)
BATCH_BOUNDS = (1, 2, 4, 8, 16, 32, 64, 128, 256)
EXPORT_WINDOW = "15 seconds"


def read_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100, glob: str | None = None) -> DataFrame:
    """A file stream; each trigger takes at most ``max_files`` new files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def stream_ingest(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, run_id: str,
                  checkpoint: str, partition: str = "event_date", committed: Callable[[str], object] | None = None) -> StreamingQuery:
    """Write each micro-batch as a run of its own, ``run_id.batch``, in the layout of the batch tables.

    A batch that is replayed after a failure overwrites exactly its own folder, so the table holds every source row
    once. ``committed`` is called with the run after each write, to record it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"{run_id}.{batch_id}"
        (transform(batch).hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
         .parquet(f"{path}/run_id={run}"))
        if committed:
            committed(run)

    return (source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_canonical(trips: DataFrame, zones: DataFrame, run_id: str, path: str, checkpoint: str) -> DataFrame:
    """Canonical trips from a stream of bronze rows: validity, the newest row per trip, zones.

    The table under ``path`` keeps the columns that order the copies of a trip, so any later run may replace a row by
    a newer one; zones are joined when it is read.
    """
    spark = trips.sparkSession
    stream_latest(trips, valid_trips, path, checkpoint, "trip_id", S.DEDUPE_ORDER, "pickup_date").awaitTermination()
    return with_zones(latest_rows(spark, path, "trip_id", S.DEDUPE_ORDER, "pickup_date"), zones, run_id)


def _bounds(value, bounds: Sequence[int], name: str) -> list:
    """Cumulative histogram counts: values up to each bound, and all values."""
    return [F.count(F.when(value <= b, 1)).alias(f"{name}_le_{b}") for b in bounds] + [
        F.count(value).alias(f"{name}_le_inf")]


def metric_rollup(log: DataFrame, event_time: str = "ts", window: str = EXPORT_WINDOW, delay: str | None = None,
                  latency_bounds: Sequence[int] = LATENCY_BOUNDS, batch_bounds: Sequence[int] = BATCH_BOUNDS) -> DataFrame:
    """Requests, errors and histograms per export interval, route, method and status.

    Works on a batch and, with a watermark ``delay``, on a stream. The counters are
    combined before the shuffle, so a hot route sends one row per task and window.
    """
    timed = log.withColumn("_event_time", as_instant(F.col(event_time)))
    timed = timed.withWatermark("_event_time", delay) if delay else timed
    return (
        timed.groupBy(F.window("_event_time", window).alias("w"), "route", "method", "status_code")
        .agg(
            F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("status_code") >= 400, 1)).alias("errors"),
            F.sum("latency_ms").alias("latency_sum"),
            *_bounds(F.col("latency_ms"), latency_bounds, "latency"),
            F.sum("batch_size").alias("batch_sum"), *_bounds(F.col("batch_size"), batch_bounds, "batch"),
        )
        .select(utc_wall(F.col("w.start")).alias("window_start"), utc_wall(F.col("w.end")).alias("window_end"), "*")
        .drop("w")
    )


def in_flight(log: DataFrame, event_time: str = "ts", window: str = EXPORT_WINDOW) -> DataFrame:
    """Change in open requests per route and export interval: starts minus finishes."""
    finish = F.timestamp_add("MICROSECOND", (F.col("latency_ms") * 1000).cast("bigint"), F.col(event_time))
    moves = log.select("route", F.explode(F.array(
        F.struct(F.col(event_time).alias("at"), F.lit(1).alias("delta")),
        F.struct(finish.alias("at"), F.lit(-1).alias("delta")))).alias("m")).select("route", "m.at", "m.delta")
    return (moves.groupBy(F.window("at", window).alias("w"), "route").agg(F.sum("delta").alias("net_started"))
            .select(F.col("w.start").alias("window_start"), "route", "net_started"))


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all available input into a Parquet folder and return the result."""
    spark = stream.sparkSession
    base = scratch_dir(spark, name)
    query = (stream.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
