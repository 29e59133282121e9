"""Live service metrics: every window visible at once, late rows counted, open requests as a level.

A micro-batch writes its own sums per window (see :mod:`waymark.streaming.batches`); readers add up the folders. An
open window is simply one that later batches add to, and a late row still reaches its window. What the batches
before say about time decides which rows are late, so a replay counts the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from waymark.streaming.batches import complete, write_batch
from waymark.streaming.jobs import EXPORT_WINDOW, in_flight, metric_rollup

GROUP = ("window_start", "window_end", "route", "method", "status_code")


def stream_metrics(log: DataFrame, path: str, checkpoint: str, window: str = EXPORT_WINDOW, delay: str = "10 minutes", event_time: str = "ts") -> StreamingQuery:
    """Sums of each micro-batch; rows older than ``delay`` behind the newest row of earlier batches count as late."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in complete(spark, f"{path}/newest", "batch") if n < batch_id]
        newest = None
        if earlier:
            newest = spark.read.parquet(*[f"{path}/newest/batch={n}" for n in earlier]).agg(F.max("newest")).first()[0]
        border = F.lit(newest and str(newest)).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        write_batch(metric_rollup(batch, event_time, window), f"{path}/rollup", batch_id)
        write_batch(in_flight(batch, event_time, window), f"{path}/moves", batch_id)
        late = batch.where(F.col(event_time) < border).groupBy("route").agg(F.count(F.lit(1)).alias("late_rows"))
        write_batch(late, f"{path}/late", batch_id)
        write_batch(batch.agg(F.max(event_time).alias("newest")), f"{path}/newest", batch_id)

    return log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _sums(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    numbers = complete(spark, path, "batch")
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in numbers]).drop("batch")
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def live_rollup(spark: SparkSession, path: str) -> DataFrame:
    """All windows so far, open ones included."""
    return _sums(spark, f"{path}/rollup", GROUP)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """``route, late_rows``; they are part of their windows, too."""
    return _sums(spark, f"{path}/late", ("route",))


def open_requests(moves: DataFrame) -> DataFrame:
    """Requests open at the end of each window, from the changes of :func:`waymark.streaming.jobs.in_flight`.

    A route has one row per window here, however many requests it had.
    """
    upto = Window.partitionBy("route").orderBy("window_start")
    return moves.withColumn("open_at_end", F.sum("net_started").over(upto))


def live_open_requests(spark: SparkSession, path: str) -> DataFrame:
    return open_requests(_sums(spark, f"{path}/moves", ("window_start", "route")))
