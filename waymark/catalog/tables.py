"""Small sinks and sources, written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog import fixtures as X
from waymark.catalog.elt import FLAGSHIP
from waymark.catalog.registry import query, table
from waymark.functions.times import epoch_second
from waymark.operators.trailing import trailing_features
from waymark.plans.gold import HISTORY_FEATURES
from waymark.session import scratch_dir
from waymark.sources.lake import Lake, write_json_report
from waymark.sources.readers import read_csv_lookup


@query("csv_lookup", """
SELECT cast(s_suppkey AS varchar) AS s_suppkey, s_name, cast(s_nationkey AS varchar) AS s_nationkey FROM supplier""")
def csv_lookup(spark, sf):
    """A lookup file in CSV: the header names the columns, every value stays text."""
    path = scratch_dir(spark, "lookup")
    table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.option("header", True).csv(path)
    return read_csv_lookup(spark, path)


@query("rerun_replaces_run", """
SELECT o_orderstatus AS run_id, count(*) AS n_rows, cast(sum(o_orderkey) AS bigint) AS keys FROM orders GROUP BY 1""")
def rerun_replaces_run(spark, sf):
    """Every run appends its rows; one had left rows behind, which its next attempt drops first."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("run_id"))
    lake = Lake(spark, scratch_dir(spark, "lake"))
    lake.append(orders, "bronze.orders", ["run_id"], "all")
    lake.append(orders.where("run_id = 'F'"), "bronze.orders", ["run_id"], "F")
    lake.drop_run("bronze.orders", "F")
    lake.append(orders.where("run_id = 'F'"), "bronze.orders", ["run_id"], "F")
    return lake.read("bronze.orders").groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"))


@query("json_report", "SELECT o_orderpriority, count(*) AS n_rows, max(o_orderkey) AS newest FROM orders GROUP BY 1")
def json_report(spark, sf):
    """A report in JSON lines, read back."""
    path = scratch_dir(spark, "report")
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"), F.max("o_orderkey").alias("newest"))
    write_json_report(counts, path)
    return spark.read.json(path)


@query("cold_start_nan", f"""
SELECT count(*) FILTER (avg_duration_7d_zone_hour IS NULL) AS duration_nan, count(*) FILTER (avg_fare_30d_zone IS NULL) AS fare_nan,
  count(*) FILTER (trip_count_90d_zone_hour = 0) AS zero_trips, 0::bigint AS nulls FROM ({FLAGSHIP}) f""")
def cold_start_nan(spark, sf):
    """Trips without history carry NaN means and a count of 0, never NULL."""
    trips = X.event_trips(spark, sf).select("pickup_ts", "pickup_hour", "pickup_zone_id", "fare_amount", S.LABEL)
    out = trailing_features(trips, epoch_second(F.col("pickup_ts")), HISTORY_FEATURES).where(F.col(S.LABEL) >= 1.0)
    means = ("avg_duration_7d_zone_hour", "avg_fare_30d_zone")
    nan = [F.count(F.when(F.isnan(c), 1)).alias(n) for c, n in zip(means, ("duration_nan", "fare_nan"))]
    null = F.col(means[0]).isNull() | F.col(means[1]).isNull() | F.col("trip_count_90d_zone_hour").isNull()
    return out.agg(*nan, F.count(F.when(F.col("trip_count_90d_zone_hour") == 0, 1)).alias("zero_trips"), F.count(F.when(null, 1)).alias("nulls"))
