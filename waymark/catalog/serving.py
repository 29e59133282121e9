"""JSON requests, responses and service metrics, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog import fixtures as X
from waymark.catalog.registry import SparkDialect, query, table
from waymark.operators.inline_scoring import instance_values, predict_in_rows, responses
from waymark.operators.requests import (explode_requests, failed_requests, feature_rows, parse_requests, quarantine,
                                        response_rows, scoring_rows, slow_requests, validate_requests)
from waymark.operators.scoring import CANDIDATES, MAX_ROUNDS, fit, score_batches
from waymark.operators.metrics import label_cap
from waymark.plans.scoring import score_requests
from waymark.session import scratch_dir
from waymark.streaming import metrics
from waymark.streaming.batches import latest_rows, stream_latest
from waymark.streaming.jobs import BATCH_BOUNDS, LATENCY_BOUNDS, in_flight, metric_rollup, read_files, stream_canonical, stream_ingest

KIND = "event_id % 16"
_ERRORS = {
    4: "Invalid JSON body", 5: "Body must contain one or more instances", 6: "Body must contain one or more instances",
    7: "Instance at index 1 must be an object", 8: "Missing required features at row 1: pickup_month",
    9: "Unexpected features at row 0: aaa, zzz", 10: "Feature 'pickup_dow' is null at row 0",
    11: "Feature 'pickup_dow' must be numeric at row 0", 12: "Feature 'route_pair_id' must be numeric at row 0",
    14: "Too many instances: 257 > 256", 15: "Feature 'pickup_hour' must be finite at row 0",
}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_ERROR_SQL = f"CASE {KIND} " + " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in _ERRORS.items()) + " END"
_STATUS_SQL = f"CASE WHEN {KIND} IN (0, 1, 2, 3, 13) THEN 200 WHEN {KIND} = 4 THEN 400 ELSE 422 END"
_COUNT_SQL = f"CASE {KIND} WHEN 0 THEN 2 WHEN 4 THEN 0 WHEN 5 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN 2 WHEN 8 THEN 2 WHEN 14 THEN 257 ELSE 1 END"


@query("request_parse", f"""
SELECT event_id AS request_id, {KIND} <> 4 AS readable, cast({_COUNT_SQL} AS int) AS n_instances FROM events""")
def request_parse(spark, sf):
    return parse_requests(X.requests(spark, sf)).select("request_id", "readable", "n_instances")


@query("request_instances", f"""
SELECT event_id AS request_id, cast(i AS int) AS row_index FROM (SELECT *, {_COUNT_SQL} AS n FROM events) e, range(2) t(i)
WHERE n <= 256 AND i < n""")
def request_instances(spark, sf):
    return explode_requests(X.requests(spark, sf)).select("request_id", "row_index")


@query("request_validate", f"""
SELECT event_id AS request_id, cast({_STATUS_SQL} AS int) AS status_code, {_ERROR_SQL} AS error FROM events""")
def request_validate(spark, sf):
    return validate_requests(X.requests(spark, sf)).select("request_id", "status_code", "error")


@query("request_status", f"SELECT cast({_STATUS_SQL} AS int) AS status_code, count(*) AS n_requests FROM events GROUP BY 1")
def request_status(spark, sf):
    return validate_requests(X.requests(spark, sf)).groupBy("status_code").agg(F.count(F.lit(1)).alias("n_requests"))


@query("request_quarantine", f"SELECT event_id AS request_id, {_ERROR_SQL} AS error FROM events WHERE {_STATUS_SQL} <> 200")
def request_quarantine(spark, sf):
    return quarantine(validate_requests(X.requests(spark, sf)), "request_id").select("request_id", "error")


@query("request_features", f"""
SELECT event_id AS request_id, cast(i AS int) AS row_index, cast(hour(ts) AS double) AS pickup_hour,
  CASE WHEN {KIND} = 13 THEN 12.5::double ELSE cast(event_id % 4097 AS double) END AS route_pair_id,
  event_id % 900 + 0.5::double AS avg_duration_7d_zone_hour
FROM events, range(2) t(i) WHERE {_STATUS_SQL} = 200 AND i < {_COUNT_SQL}""")
def request_features(spark, sf):
    rows = feature_rows(validate_requests(X.requests(spark, sf)), "request_id")
    return rows.select("request_id", "row_index", *[F.col(c).cast("double").alias(c) for c in (
        "pickup_hour", "route_pair_id", "avg_duration_7d_zone_hour")])


_ONE = "(event_id % 900 + 1.5)::double"
_BODY = (f"CASE WHEN {KIND} = 0 THEN concat({_ONE}, ',', {_ONE}) ELSE concat({_ONE}) END")


@query("score_batch", f"""
SELECT event_id AS request_id, cast({_STATUS_SQL} AS int) AS status_code,
  CASE WHEN {_STATUS_SQL} = 200 THEN '{{"model_version":"m1","n_instances":' || {_COUNT_SQL} || ',"predictions":[' || {_BODY} || ']}}'
  ELSE to_json({{'detail': {_ERROR_SQL}}})::varchar END AS response FROM events""")
def score_batch(spark, sf):
    """Requests through an external scorer (here the 7-day mean plus one second) to response texts."""
    return _mean_plus_one(X.requests(spark, sf))


def _mean_plus_one(requests):
    place = S.FEATURES.index("avg_duration_7d_zone_hour")

    def load():
        import numpy as np

        return lambda m: np.log1p(m[:, place].astype("float64") + 1.0)

    scored = predict_in_rows(instance_values(validate_requests(requests), "request_id"), load, 86_400.0)
    return responses(scored.withColumn("predictions", F.transform("predictions", lambda p: F.round(p, 6))), "request_id", "m1")


@query("score_repeated_ids", f"""
SELECT event_id % 97 AS request_id, cast({_STATUS_SQL} AS int) AS status_code,
  CASE WHEN {_STATUS_SQL} = 200 THEN '{{"model_version":"m1","n_instances":' || {_COUNT_SQL} || ',"predictions":[' || {_BODY} || ']}}'
  ELSE to_json({{'detail': {_ERROR_SQL}}})::varchar END AS response FROM events""")
def score_repeated_ids(spark, sf):
    """Clients that use an id again: every request keeps an answer of its own."""
    return _mean_plus_one(X.requests(spark, sf).withColumn("request_id", F.col("request_id") % 97))


@query("score_exploded", f"""
SELECT event_id AS request_id, cast({_STATUS_SQL} AS int) AS status_code,
  CASE WHEN {_STATUS_SQL} = 200 THEN '{{"model_version":"m1","n_instances":' || {_COUNT_SQL} || ',"predictions":[' || {_BODY} || ']}}'
  ELSE to_json({{'detail': {_ERROR_SQL}}})::varchar END AS response FROM events""")
def score_exploded(spark, sf):
    """The same requests as one row per instance, for models that only take rows."""
    place = S.FEATURES.index("avg_duration_7d_zone_hour")

    def load():
        import numpy as np

        return lambda m: np.log1p(m[:, place].astype("float64") + 1.0)

    keys = ["request_id", "n_instances", "status_code", "error", "row_index"]
    rows = scoring_rows(validate_requests(X.requests(spark, sf)), "request_id")
    scored = score_batches(rows, load, keys, 86_400.0).withColumn("prediction_seconds", F.round("prediction_seconds", 6))
    return response_rows(scored, "request_id", "m1")


@query("score_requests")
def score_with_trees(spark, sf):
    """The same requests through a fitted tree model."""
    train = X.matrix(spark, sf)
    cap, _ = label_cap(train, S.LABEL)
    return score_requests(X.requests(spark, sf), fit(train, CANDIDATES[5], cap, MAX_ROUNDS), cap, "m1")


# --- request log ----------------------------------------------------------------------------------

@query("slow_requests", f"SELECT ts, route, latency_ms FROM ({X.LOG}) l WHERE latency_ms >= 500")
def slow(spark, sf):
    return slow_requests(X.request_log(spark, sf)).select("ts", "route", "latency_ms")


@query("failed_requests", f"SELECT route, status_code, count(*) AS n FROM ({X.LOG}) l WHERE status_code >= 400 GROUP BY ALL")
def failed(spark, sf):
    return failed_requests(X.request_log(spark, sf)).groupBy("route", "status_code").agg(F.count(F.lit(1)).alias("n"))


def _hist(column: str, bounds, name: str) -> str:
    return ", ".join([f"count(*) FILTER ({column} <= {b}) AS {name}_le_{b}" for b in bounds] + [f"count({column}) AS {name}_le_inf"])


def _rollup_sql(seconds: int) -> str:
    start = f"time_bucket(INTERVAL {seconds} SECOND, ts, TIMESTAMP '1970-01-01')"
    return f"""
SELECT {start} AS window_start, {start} + INTERVAL {seconds} SECOND AS window_end, route, method, status_code, count(*) AS requests,
  count(*) FILTER (status_code >= 400) AS errors, sum(latency_ms) AS latency_sum, {_hist('latency_ms', LATENCY_BOUNDS, 'latency')},
  cast(sum(batch_size) AS bigint) AS batch_sum, {_hist('batch_size', BATCH_BOUNDS, 'batch')}
FROM ({X.LOG}) l GROUP BY ALL"""


@query("metric_rollup", _rollup_sql(15))
def rollup(spark, sf):
    return metric_rollup(X.request_log(spark, sf))


@query("in_flight", f"""
WITH l AS ({X.LOG}), m AS (SELECT ts AS moment, route, 1 AS d FROM l
  UNION ALL SELECT ts + to_microseconds(cast(latency_ms * 1000 AS bigint)), route, -1 FROM l)
SELECT time_bucket(INTERVAL 15 SECOND, moment, TIMESTAMP '1970-01-01') AS window_start, route, cast(sum(d) AS bigint) AS net_started
FROM m GROUP BY ALL""")
def open_requests(spark, sf):
    return in_flight(X.request_log(spark, sf))


# --- streams --------------------------------------------------------------------------------------

def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_files(spark, sf, schema, max_files=1, glob="events.parquet")


def _newest_first(spark, rows, name, files=4):
    """A stream over four parts of ``rows``, the newest first, one per trigger; rows without ``ts`` come last."""
    path = scratch_dir(spark, name)
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = rows.agg(F.percentile_approx(seconds, [0.25, 0.5, 0.75], 1000)).first()[0] or []
    part = sum((F.when(seconds > c, 1).otherwise(0) for c in cuts), F.lit(0))
    for k in reversed(range(len(cuts) + 1)):
        rows.where(part == k).repartition(files).write.mode("append").parquet(path)
    return read_files(spark, path, rows.schema, max_files=files)


def _log_stream(spark, sf):
    return _newest_first(spark, X.request_log(spark, sf), "log-input")


@query("stream_metric_rollup", f"""
WITH r AS ({_rollup_sql(3600)}) SELECT window_start, route, status_code, requests, errors, latency_sum, latency_le_100, batch_sum FROM r""")
def stream_metric_rollup(spark, sf):
    """All windows, from a log that arrives newest part first."""
    base = scratch_dir(spark, "metrics")
    metrics.stream_metrics(_log_stream(spark, sf), f"{base}/table", f"{base}/state", "1 hour").awaitTermination()
    return metrics.live_rollup(spark, f"{base}/table").select("window_start", "route", "status_code", "requests", "errors", "latency_sum", "latency_le_100", "batch_sum")


@query("stream_open_requests", f"""
WITH l AS ({X.LOG}), m AS (SELECT ts AS moment, route, 1 AS d FROM l
  UNION ALL SELECT ts + to_microseconds(cast(latency_ms * 1000 AS bigint)), route, -1 FROM l),
n AS (SELECT time_bucket(INTERVAL 15 SECOND, moment, TIMESTAMP '1970-01-01') AS window_start, route, cast(sum(d) AS bigint) AS net_started FROM m GROUP BY ALL)
SELECT window_start, route, net_started, cast(sum(net_started) OVER (PARTITION BY route ORDER BY window_start) AS bigint) AS open_at_end FROM n""")
def stream_open_requests(spark, sf):
    """The level of open requests at the end of every export window."""
    base = scratch_dir(spark, "metrics")
    metrics.stream_metrics(_log_stream(spark, sf), f"{base}/table", f"{base}/state").awaitTermination()
    return metrics.live_open_requests(spark, f"{base}/table").select("window_start", "route", "net_started", "open_at_end")


@query("stream_dedupe", """
SELECT event_id, ts, cast(round(value * 100) AS bigint) + 1 AS cents FROM events""")
def deduped_stream(spark, sf):
    """Every event arrives twice, newest part first and the newer copy before the older; the newest copies stay."""
    events = table(spark, sf, "events").select("event_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    copies = events.withColumn("version", F.explode(F.array(F.lit(2), F.lit(1)))).withColumn("cents", F.col("cents") + F.col("version") - 1)
    base = scratch_dir(spark, "latest")
    stream, spec = _newest_first(spark, copies, "latest-input"), ("event_id", ["version"], "day")
    stream_latest(stream, lambda b: b.withColumn("day", F.to_date("ts")), f"{base}/table", f"{base}/state", *spec, fold_every=3).awaitTermination()
    return latest_rows(spark, f"{base}/table", *spec).select("event_id", "ts", "cents")


@query("stream_ingest", """
SELECT event_id, cast(ts AS date) AS event_date, cast(round(value * 100) AS bigint) AS cents FROM events""")
def ingested_stream(spark, sf):
    base = scratch_dir(spark, "ingest")
    query_ = stream_ingest(
        _event_stream(spark, sf),
        lambda b: b.select("event_id", F.to_date("ts").alias("event_date"), F.round(F.col("value") * 100).cast("bigint").alias("cents")),
        f"{base}/table", "run-1", f"{base}/state")
    query_.awaitTermination()
    return spark.read.parquet(f"{base}/table").select("event_id", "event_date", "cents")


@query("stream_canonical", f"""
SELECT pickup_ts, dropoff_ts, pickup_location_id, dropoff_location_id, pickup_borough, dropoff_service_zone,
  trip_duration_seconds, fare_amount, 2.0 AS tip_amount FROM ({X.SILVER}) s WHERE trip_duration_seconds > 0""")
def canonical_stream(spark, sf):
    """Events as bronze rows in four parts, each arriving as two copies with other tips, through the streaming canonical job."""
    events = table(spark, sf, "events")
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(2), F.lit(1))))
    exprs = X.event_trip_exprs(SparkDialect)
    bronze = _newest_first(spark, twice, "canonical-input").selectExpr(*[f"{e} AS {a}" for a, e in exprs.items()], "_copy").select(
        "pickup_ts", "dropoff_ts", F.col("pickup_zone_id").cast("bigint").alias("pickup_location_id"),
        F.col("dropoff_zone_id").cast("bigint").alias("dropoff_location_id"), F.col("event_id").alias("vendor_id"),
        F.lit(1.0).alias("trip_distance"), "fare_amount", F.col("fare_amount").alias("total_amount"), F.col("_copy").cast("double").alias("tip_amount"),
        *[F.lit("x").alias(c) for c in S.LINEAGE_COLUMNS if c != "ingestion_ts"],
        F.timestamp_add("SECOND", F.col("_copy"), F.col("pickup_ts")).alias("ingestion_ts"))
    base = scratch_dir(spark, "canonical")
    out = stream_canonical(bronze, X.zones(spark, sf), "run-1", f"{base}/table", f"{base}/state")
    return out.select("pickup_ts", "dropoff_ts", "pickup_location_id", "dropoff_location_id", "pickup_borough",
                      "dropoff_service_zone", "trip_duration_seconds", "fare_amount", "tip_amount")
