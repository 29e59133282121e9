"""Trip-shaped views of the test tables, for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog.registry import SparkDialect, select, spark_select, table
from waymark.session import spread_small

# --- zones: nations as zones, regions as boroughs -------------------------------------


def zone_exprs(d) -> dict[str, str]:
    return {
        "location_id": "cast(n_nationkey AS bigint)",
        "borough": "CASE n_regionkey WHEN 0 THEN 'Manhattan' WHEN 1 THEN ' queens ' WHEN 2 THEN 'BROOKLYN' "
                   "WHEN 3 THEN 'Atlantis' ELSE NULL END",
        "zone": "n_name",
        "service_zone": "CASE n_nationkey % 4 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN ' boro zone ' "
                        "WHEN 2 THEN 'Airports' ELSE 'unknown' END",
    }


ZONES = select(zone_exprs, "nation")


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "nation"), zone_exprs)


# --- E: one trip per event; fares are whole cents so that sums are exact ----------------


def event_trip_exprs(d) -> dict[str, str]:
    return {
        "event_id": "event_id",
        "pickup_ts": "ts",
        "dropoff_ts": d.add_seconds("ts", "floor(value * 10)"),
        "pickup_zone_id": "cast(user_id % 25 AS int)",
        "dropoff_zone_id": "cast((event_id * 7 + user_id) % 25 AS int)",
        "pickup_hour": "cast(hour(ts) AS int)",
        "fare_amount": "round(value * 100)",
        S.LABEL: "cast(floor(value * 10) AS double)",
    }


EVENT_TRIPS = select(event_trip_exprs, "events")
SECOND = "cast(epoch_us({ts}) // 1000000 AS bigint)"


def event_trips(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "events"), event_trip_exprs)


# --- S: events shaped as canonical trips -------------------------------------------------

SILVER = f"""
SELECT sha256(cast(event_id AS varchar)) AS trip_id, pickup_ts, dropoff_ts,
  cast(pickup_zone_id AS bigint) AS pickup_location_id, cast(dropoff_zone_id AS bigint) AS dropoff_location_id,
  p.borough AS pickup_borough, p.service_zone AS pickup_service_zone,
  q.borough AS dropoff_borough, q.service_zone AS dropoff_service_zone,
  cast({S.LABEL} AS bigint) AS trip_duration_seconds, fare_amount
FROM ({EVENT_TRIPS}) e
LEFT JOIN ({ZONES}) p ON e.pickup_zone_id = p.location_id
LEFT JOIN ({ZONES}) q ON e.dropoff_zone_id = q.location_id
"""


def silver(spark: SparkSession, sf: str) -> DataFrame:
    from waymark.operators.lookups import attach_zone_roles

    trips = event_trips(spark, sf).select(
        F.sha2(F.col("event_id").cast("string"), 256).alias("trip_id"), "pickup_ts", "dropoff_ts",
        F.col("pickup_zone_id").cast("bigint").alias("pickup_location_id"),
        F.col("dropoff_zone_id").cast("bigint").alias("dropoff_location_id"),
        F.col(S.LABEL).cast("bigint").alias("trip_duration_seconds"), "fare_amount", F.lit("r1").alias("silver_run_id"))
    return attach_zone_roles(trips, zones(spark, sf))


# --- L: one trip per order line ------------------------------------------------------------

LINE_TRIPS = """
SELECT l_orderkey, l_linenumber, o_orderdate AS pickup_ts, l_shipdate AS dropoff_ts,
  cast(c_nationkey AS bigint) AS pickup_location_id, cast(s_nationkey AS bigint) AS dropoff_location_id,
  cast(l_linenumber AS bigint) AS vendor_id, l_quantity AS trip_distance, l_extendedprice AS fare_amount,
  cast(floor(l_extendedprice * (1 + l_tax)) AS double) AS total_amount, l_returnflag AS source_file,
  cast(cast(l_linenumber AS bigint) % 3 AS bigint) AS payment_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
"""


def line_trips(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        "l_orderkey", "l_linenumber", F.col("o_orderdate").alias("pickup_ts"), F.col("l_shipdate").alias("dropoff_ts"),
        F.col("c_nationkey").cast("bigint").alias("pickup_location_id"),
        F.col("s_nationkey").cast("bigint").alias("dropoff_location_id"),
        F.col("l_linenumber").cast("bigint").alias("vendor_id"), F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.floor(F.col("l_extendedprice") * (1 + F.col("l_tax"))).cast("double").alias("total_amount"),
        F.col("l_returnflag").alias("source_file"), (F.col("l_linenumber").cast("bigint") % 3).alias("payment_type"),
    )


# --- dirty raw trips: unreadable, blank and padded text --------------------------------------


def dirty_exprs(d) -> dict[str, str]:
    day = d.text("cast(ts AS date)")
    return {
        "event_id": "event_id",
        "pickup_raw": f"CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'garbage' WHEN 2 THEN concat(' ', {day}, ' 10:11:12 ') "
                      f"WHEN 3 THEN concat({day}, 'T10:11:12.5') WHEN 4 THEN NULL ELSE {day} END",
        "second_raw": f"CASE event_id % 4 WHEN 0 THEN concat({day}, ' 23:59:59') WHEN 1 THEN 'soon' ELSE NULL END",
        "long_raw": f"CASE event_id % 5 WHEN 0 THEN '1.0' WHEN 1 THEN {d.text('user_id')} WHEN 2 THEN ' +7 ' "
                    "WHEN 3 THEN 'x' ELSE '99999999999999999999' END",
        "double_raw": "CASE event_id % 4 WHEN 0 THEN '1e2' WHEN 1 THEN '1d' WHEN 2 THEN 'NaN' ELSE '.5' END",
        "cents_raw": d.text("cast(round(value * 100) AS bigint)"),
    }


DIRTY = select(dirty_exprs, "events")


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "events"), dirty_exprs)


# --- M: matrix-shaped rows, with or without broken ones --------------------------------------


def matrix_exprs(broken: bool):
    def bad(n: int, then: str, otherwise: str) -> str:
        return f"CASE WHEN event_id % {n} = 0 THEN {then} ELSE {otherwise} END" if broken else otherwise

    def build(d) -> dict[str, str]:
        key = "event_id - CASE WHEN event_id % 50 = 1 THEN 1 ELSE 0 END" if broken else "event_id"
        nan = "cast('NaN' AS double)"
        return {
            "trip_id": bad(97, "'short'", bad(89, "NULL", d.sha(d.text(f"({key})")))),
            "pickup_ts": bad(101, "NULL", "ts"),
            "as_of_ts": bad(103, d.add_seconds("ts", "1"), "ts"),
            "as_of_date": "cast(" + bad(107, d.add_seconds("ts", "86400"), "ts") + " AS date)",
            "schema_version": bad(997, "'other'", f"'{S.SCHEMA_VERSION}'"),
            "feature_version": f"'{S.FEATURE_VERSION}'",
            "pickup_hour": "cast(" + bad(109, "hour(ts) + 24", "hour(ts)") + " AS int)",
            "pickup_dow": d.dow("ts"),
            "pickup_month": "cast(month(ts) AS int)",
            "pickup_is_weekend": f"CASE WHEN {d.dow('ts')} IN (1, 7) THEN 1 ELSE 0 END",
            "pickup_borough_id": "cast(user_id % 7 AS int)",
            "pickup_zone_id": "cast(" + bad(113, "-1", "user_id % 25") + " AS int)",
            "pickup_service_zone_id": "cast(user_id % 4 AS int)",
            "dropoff_borough_id": "cast(event_id % 7 AS int)",
            "dropoff_zone_id": "cast(" + bad(127, "NULL", "event_id % 25") + " AS int)",
            "dropoff_service_zone_id": "cast(event_id % 4 AS int)",
            "route_pair_id": "cast((user_id * 31 + event_id) % 4097 AS int)",
            "avg_duration_7d_zone_hour": f"CASE WHEN event_id % 20 = 0 THEN {nan} ELSE "
                                         + bad(131, "cast('Infinity' AS double)", "value") + " END",
            "avg_fare_30d_zone": bad(137, "cast(NULL AS double)", bad(139, "-value", "value * 2")),
            "trip_count_90d_zone_hour": "cast(event_id % 90 AS double)",
            S.LABEL: bad(149, "cast(0 AS double)", bad(151, nan, "cast(floor(value * 10) + 1 AS double)")),
        }
    return build


MATRIX = select(matrix_exprs(False), "events")
BROKEN_MATRIX = select(matrix_exprs(True), "events")


def matrix(spark: SparkSession, sf: str, broken: bool = False) -> DataFrame:
    return spark_select(table(spark, sf, "events"), matrix_exprs(broken))


# --- contracts: one per customer ---------------------------------------------------------------

_COLUMNS_JSON = "[" + ",".join(f'"{c}"' for c in S.MATRIX_COLUMNS) + "]"


def contract_exprs(d) -> dict[str, str]:
    key = d.text("c_custkey")
    return {
        "run_id": f"concat('run-', {key})",
        "feature_version": f"concat('v', {d.text('c_custkey % 300')})",
        "schema_version": f"'{S.SCHEMA_VERSION}'",
        "schema_hash": f"CASE WHEN c_custkey % 11 = 0 THEN 'nothex' ELSE {d.sha(key)} END",
        "model_family": "'lightgbm'",
        "inference_runtime": "'onnxruntime'",
        "gold_table": "'lake.gold.m'",
        "source_silver_table": "'lake.silver.t'",
        "source_silver_snapshot_id": key,
        "training_row_count": "cast(c_custkey % 13 AS bigint)",
        "output_columns_json": f"CASE WHEN c_custkey % 17 = 0 THEN '[\"a\"]' ELSE '{_COLUMNS_JSON}' END",
        "feature_spec_json": "concat('{\"output_columns\":[{\"name\":\"f', " + d.text("c_nationkey")
                             + ", '\",\"role\":\"feature\",\"dtype\":\"int32\",\"nullable\":false,\"missing_policy\":\"required\"}]}')",
        "encoding_spec_json": "concat('{\"z\":{\"type\":\"versioned_lookup\",\"unknown\":0,\"source\":\"s\",\"values\":{\"1\":\"', "
                              "c_mktsegment, CASE WHEN c_custkey % 19 = 0 THEN '\"' ELSE '\",\"2\":\"b\"}}}' END)",
        "aggregate_spec_json": "'[{\"name\":\"a\",\"source_column\":\"c\",\"window_length\":\"7d\",\"grouping_keys\":[\"k\",\"h\"],"
                               "\"null_fallback\":\"NaN\"}]'",
        "label_spec_json": "'{\"name\":\"label\",\"unit\":\"seconds\"}'",
        "created_ts": d.add_seconds("cast('2024-01-01 00:00:00' AS " + ("timestamp_ntz" if d is SparkDialect else "timestamp") + ")",
                                    "c_custkey"),
    }


CONTRACTS = select(contract_exprs, "customer")


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "customer"), contract_exprs)


# --- commit history and file listings: orders as commits and files -----------------------------


def history_exprs(d) -> dict[str, str]:
    return {
        "table_id": f"concat('t', {d.text('o_custkey')})", "snapshot_id": d.text("o_orderkey"),
        "made_current_at": d.add_seconds("o_orderdate", "o_orderkey % 86400"),
        "is_current_ancestor": "o_orderstatus <> 'P'", "is_current": "o_orderpriority = '1-URGENT'",
    }


HISTORY = select(history_exprs, "orders")


def history(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "orders"), history_exprs)


def file_exprs(d) -> dict[str, str]:
    day = d.text("cast(o_orderdate AS date)")
    return {
        "path": f"concat('s3://bucket/gold/m/as_of_date=', {day}, '/part-', {d.text('o_orderkey')}, '.parquet')",
        "partition": f"concat('as_of_date=', {day})", "as_of_date": "cast(o_orderdate AS date)",
        "bytes": "cast(floor(o_totalprice) AS bigint) * 1000", "modified": "o_orderdate", "status": "o_orderstatus",
    }


FILES = select(file_exprs, "orders")


def files(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "orders"), file_exprs)


# --- JSON requests: sixteen kinds of body --------------------------------------------------------


def _instance() -> Column:
    """A good instance as JSON text."""
    hour, user, event = F.hour("ts"), F.col("user_id"), F.col("event_id")
    values = {
        "pickup_hour": hour, "pickup_dow": user % 7 + 1, "pickup_month": F.month("ts"), "pickup_is_weekend": event % 2,
        "pickup_borough_id": user % 7, "pickup_zone_id": user % 25, "pickup_service_zone_id": user % 4,
        "dropoff_borough_id": event % 7, "dropoff_zone_id": event % 25, "dropoff_service_zone_id": event % 4,
        "route_pair_id": event % 4097, "avg_duration_7d_zone_hour": F.concat((event % 900).cast("string"), F.lit(".5")),
        "avg_fare_30d_zone": F.concat(user.cast("string"), F.lit(".25")), "trip_count_90d_zone_hour": event % 90,
    }
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v.cast("string")) for k, v in values.items()]),
                    F.lit("}"))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per event; the body kind is ``event_id % 16``."""
    good = F.col("good")

    def swap(field: str, value: str) -> Column:
        return F.regexp_replace(good, rf'"{field}":\d+', f'"{field}":{value}')

    no_month = F.regexp_replace(good, r'"pickup_month":\d+,', "")
    two_extra = F.concat(F.substring_index(good, "}", 1), F.lit(',"zzz":1,"aaa":2}'))
    bodies = [
        ('{"instances":[', good, ",", good, "]}"), ('{"inputs":[', good, "]}"), ("[", good, "]"), (good,),
        ('{"instances":[{"pickup_hour":1',), ('{"instances":[]}',), ('{"instances":"x"}',), ("[", good, ",1]"),
        ("[", good, ",", no_month, "]"), ("[", two_extra, "]"), ("[", swap("pickup_dow", "null"), "]"),
        ("[", swap("pickup_dow", "true"), "]"), ("[", swap("route_pair_id", '"abc"'), "]"),
        ("[", swap("route_pair_id", '"12.5"'), "]"), ("[", F.repeat(F.lit('{"a":1},'), 256), '{"a":1}]'),
        ("[", swap("pickup_hour", '"NaN"'), "]"),
    ]
    kind = F.col("event_id") % 16
    body = F.lit(None).cast("string")
    for i, parts in enumerate(bodies):
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        body = F.when(kind == i, text).otherwise(body)
    return spread_small(table(spark, sf, "events")).withColumn("good", _instance()).select(F.col("event_id").alias("request_id"), body.alias("body"))


# --- request log: one row per event ---------------------------------------------------------------


def log_exprs(d) -> dict[str, str]:
    return {
        "ts": "ts", "route": "CASE WHEN user_id % 10 = 0 THEN '/healthz' ELSE '/predict' END",
        "method": "CASE WHEN user_id % 10 = 0 THEN 'GET' ELSE 'POST' END",
        "status_code": "CASE event_type WHEN 'error' THEN 422 WHEN 'signup' THEN 500 ELSE 200 END",
        "latency_ms": "cast(floor(value * 4) AS double)", "batch_size": "cast(event_id % 300 AS int)",
    }


LOG = select(log_exprs, "events")


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return spark_select(table(spark, sf, "events"), log_exprs)
