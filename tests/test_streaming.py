from datetime import datetime, timedelta

from pyspark.sql import functions as F

from waymark.session import scratch_dir
from waymark.streaming import batches, metrics
from waymark.streaming.batches import fold_latest, latest_rows, stream_latest
from waymark.streaming.jobs import drain, in_flight, metric_rollup, read_files, stream_ingest

LOG = "ts timestamp_ntz, route string, method string, status_code int, latency_ms double, batch_size int"


def log(spark):
    t = datetime(2024, 3, 10, 2, 30)  # inside the hour New York skips
    rows = [(t + timedelta(seconds=s), "/predict", "POST", code, ms, n) for s, code, ms, n in
            ((0, 200, 4.0, 1), (3, 200, 60.0, 16), (14, 422, 1200.0, 1), (15, 500, 20000.0, 300), (16, 200, 5.0, 4))]
    return spark.createDataFrame(rows, LOG)


def test_rollup(spark):
    rows = {(r.window_start, r.status_code): r for r in metric_rollup(log(spark)).collect()}
    first = rows[(datetime(2024, 3, 10, 2, 30), 200)]
    assert (first.requests, first.errors, first.latency_le_5, first.latency_le_75, first.batch_le_16, first.latency_sum) == (2, 0, 1, 2, 2, 64.0)
    last = rows[(datetime(2024, 3, 10, 2, 30, 15), 500)]
    assert (last.errors, last.latency_le_10000, last.latency_le_inf, last.batch_le_256, last.batch_sum) == (1, 0, 1, 0, 300)


def test_in_flight(spark):
    got = {r.window_start.second: r.net_started for r in in_flight(log(spark)).collect()}
    # Three start at :00-:14, two of them end there; at :15 two start and two end; the slow one ends at :35.
    assert got == {0: 1, 15: 0, 30: -1}


def test_late_rows_and_closed_windows(spark):
    path = scratch_dir(spark, "late")
    early, base = log(spark), datetime(2024, 3, 10, 6, 0)
    later = spark.createDataFrame([(base, "/predict", "POST", 200, 1.0, 1)], LOG)
    late = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 1), "/predict", "POST", 200, 1.0, 1)], LOG)
    end = spark.createDataFrame([(base + timedelta(hours=1), "/predict", "POST", 200, 1.0, 1)], LOG)
    # The watermark that judges late rows trails the newest one by a batch.
    for i, part in enumerate((early, later, later, late, end)):
        part.coalesce(1).write.mode("append").parquet(f"{path}/in{i}")
    stream = read_files(spark, f"{path}/in*", log(spark).schema, max_files=1)
    out = drain(metric_rollup(stream, delay="1 minute"), "late-rollup").collect()
    counts = {(r.window_start, r.status_code): r.requests for r in out}
    assert counts[(datetime(2024, 3, 10, 2, 30), 200)] == 2  # the late row came after its window had closed
    assert counts[(base, 200)] == 2


def test_newest_copy_wins_in_any_order(spark):
    base, t = scratch_dir(spark, "latest-test"), datetime(2024, 1, 1)
    schema = "trip_id int, ts timestamp_ntz, version int"
    for k in range(3):  # newest day first, every key twice, the newer copy in the earlier file
        day = t + timedelta(days=2 - k)
        spark.createDataFrame([(10 * k + i, day, v) for i in range(5) for v in (2, 1)], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    spark.createDataFrame([(0, t + timedelta(days=2), 3)], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = read_files(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema, max_files=1)
    stream_latest(stream, lambda b: b.withColumn("day", F.to_date("ts")), f"{base}/out", f"{base}/state", "trip_id", ["version"], "day").awaitTermination()
    want = {10 * k + i: 3 if (k, i) == (0, 0) else 2 for k in range(3) for i in range(5)}
    spec = ("trip_id", ["version"], "day")

    def held():
        rows = latest_rows(spark, f"{base}/out", *spec).collect()
        return {r.trip_id: r.version for r in rows} if len({r.trip_id for r in rows}) == len(rows) else None

    assert held() == want
    fold_latest(spark, f"{base}/out", *spec)
    assert held() == want and batches.complete(spark, f"{base}/out/new", "batch") == []
    # A late row folds its own day only, and a fold that dies before it is marked changes nothing.
    batches.write_batch(spark.createDataFrame([(10, t + timedelta(days=1), 9)], schema).withColumn("day", F.to_date("ts")), f"{base}/out/new", 7, "day")
    late = want | {10: 9}
    assert held() == late
    spark.range(1).selectExpr("int(id) AS trip_id", "timestamp_ntz'2020-01-01' AS ts", "5 AS version", "date'2020-01-01' AS day").write.partitionBy("day").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/out/base/gen=7")
    assert held() == late
    fold_latest(spark, f"{base}/out", *spec)
    assert held() == late and batches.complete(spark, f"{base}/out/base", "gen") == [3, 7]
    days = [r.day for r in spark.read.parquet(f"{base}/out/base/gen=7").select("day").distinct().collect()]
    assert days == [(t + timedelta(days=1)).date()]


def test_ingest_takes_new_files_once(spark):
    base = scratch_dir(spark, "ingest-test")
    frame = lambda a, b: spark.range(a, b).withColumn("event_date", F.lit("2024-01-01").cast("date"))
    frame(0, 10).coalesce(2).write.parquet(f"{base}/in")
    schema = frame(0, 1).schema

    def run():
        q = stream_ingest(read_files(spark, f"{base}/in", schema, max_files=1), lambda b: b, f"{base}/out", "r1", f"{base}/state")
        q.awaitTermination()

    run()
    run()
    frame(10, 15).coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    assert sorted(r.id for r in spark.read.parquet(f"{base}/out").collect()) == list(range(15))


def test_live_metrics_hold_every_window_and_count_late_rows(spark):
    base, whole = scratch_dir(spark, "live"), log(spark)
    later = spark.createDataFrame([(datetime(2024, 3, 10, 6, 0), "/predict", "POST", 200, 1.0, 1)], LOG)
    late = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 1), "/predict", "POST", 200, 1.0, 1)], LOG)
    for part in (whole, later, late):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = read_files(spark, f"{base}/in", whole.schema, max_files=1)
    metrics.stream_metrics(stream, f"{base}/out", f"{base}/state", delay="1 minute").awaitTermination()
    every = whole.unionByName(later).unionByName(late)
    order = ["window_start", "route", "status_code"]
    assert metrics.live_rollup(spark, f"{base}/out").orderBy(*order).collect() == metric_rollup(every).select(
        *metrics.live_rollup(spark, f"{base}/out").columns).orderBy(*order).collect()
    assert [tuple(r) for r in metrics.late_rows(spark, f"{base}/out").collect()] == [("/predict", 1)]
    levels = [(r.window_start.second, r.open_at_end) for r in metrics.live_open_requests(spark, f"{base}/out").orderBy("window_start").collect()]
    assert levels == [(0, 1), (15, 1), (30, 0), (0, 0)]
