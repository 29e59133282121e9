"""Landing, canonical trips, lookups, history features and the matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import settings as S
from waymark.catalog import fixtures as X
from waymark.catalog.registry import query, table
from waymark.functions.columns import normalize_columns, raw_record_json
from waymark.functions.hashing import merge_digests, route_bucket, table_digest
from waymark.functions.parsing import safe_code, safe_double, safe_long, safe_ts
from waymark.functions.times import calendar_parts, epoch_second
from waymark.operators.dedupe import dedupe_latest, duplicate_count, duplicate_keys, latest_by_key
from waymark.operators.gates import quality_summary
from waymark.operators.lookups import attach_zone_roles, fixed_code, join_coverage, sorted_codes
from waymark.operators.trailing import Trailing, trailing_features
from waymark.plans.bronze import to_bronze
from waymark.plans.elt import run_elt
from waymark.plans.gold import HISTORY_FEATURES, service_zone_values, training_matrix, usable_label
from waymark.plans.silver import canonical_trips
from waymark.session import scratch_dir
from waymark.sources.lake import Lake

SEC = "cast(epoch_us({0}) // 1000000 AS bigint)"


def _route(p: str, q: str) -> str:
    digest = f"sha256(concat_ws('||', cast({p} AS varchar), cast({q} AS varchar), '{S.ROUTE_SALT}'))"
    return (f"CASE WHEN {p} > 0 AND {q} > 0 THEN cast(cast('0x' || substr({digest}, 1, 15) AS bigint) "
            f"% {S.ROUTE_BUCKETS} AS int) + 1 ELSE 0 END")


def _frame(keys: str, ts: str, seconds: int) -> str:
    return (f"(PARTITION BY {keys} ORDER BY {SEC.format(ts)} RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING)")


def cold_start_to_null(df, *columns):
    """NaN does not compare equal to itself, so checks see NULL instead."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


# --- flagship: point-in-time features over all events ------------------------------------------

FLAGSHIP = f"""
WITH e AS ({X.EVENT_TRIPS}), w AS (
  SELECT *, {_route('pickup_zone_id', 'dropoff_zone_id')} AS route_pair_id,
    avg({S.LABEL}) OVER {_frame('pickup_zone_id, pickup_hour', 'pickup_ts', 7 * S.DAY)} AS avg_duration_7d_zone_hour,
    avg(fare_amount) OVER {_frame('pickup_zone_id', 'pickup_ts', 30 * S.DAY)} AS avg_fare_30d_zone,
    cast(count(*) OVER {_frame('pickup_zone_id, pickup_hour', 'pickup_ts', 90 * S.DAY)} AS double) AS trip_count_90d_zone_hour
  FROM e)
SELECT event_id, pickup_ts, pickup_hour, cast(dayofweek(pickup_ts) + 1 AS int) AS pickup_dow,
  cast(month(pickup_ts) AS int) AS pickup_month, CASE WHEN dayofweek(pickup_ts) IN (0, 6) THEN 1 ELSE 0 END AS pickup_is_weekend,
  pickup_zone_id, dropoff_zone_id, route_pair_id, avg_duration_7d_zone_hour, avg_fare_30d_zone, trip_count_90d_zone_hour,
  {S.LABEL}
FROM w WHERE {S.LABEL} >= 1
"""


@query("flagship_pit_features", FLAGSHIP)
def flagship_pit_features(spark, sf):
    trips = X.event_trips(spark, sf)
    pickup = F.col("pickup_ts")
    base = trips.select("event_id", "pickup_ts", *calendar_parts(pickup), "pickup_zone_id", "dropoff_zone_id",
                        route_bucket(F.col("pickup_zone_id"), F.col("dropoff_zone_id"), S.ROUTE_SALT,
                                     S.ROUTE_BUCKETS).alias("route_pair_id"), "fare_amount", S.LABEL)
    featured = trailing_features(base, epoch_second(pickup), HISTORY_FEATURES)
    out = featured.where(F.col(S.LABEL) >= 1.0).drop("fare_amount")
    return cold_start_to_null(out, "avg_duration_7d_zone_hour", "avg_fare_30d_zone")


# --- landing and parsing ------------------------------------------------------------------------

_TS = "try_cast(trim({0}) AS timestamp)"
_INT = r"CASE WHEN regexp_full_match(trim({0}), '[+-]?\d+') THEN try_cast(trim({0}) AS bigint) END"
_CODE = (r"CASE WHEN regexp_full_match(trim({0}), '[+-]?\d+(\.0*)?') "
         r"THEN try_cast(regexp_replace(trim({0}), '\.0*$', '') AS bigint) END")
_DBL = r"CASE WHEN regexp_full_match(trim({0}), '[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?') THEN try_cast(trim({0}) AS double) END"


@query("parse_values", f"""
SELECT event_id, {_TS.format('pickup_raw')} AS parsed_ts, {_INT.format('long_raw')} AS parsed_long,
  {_CODE.format('long_raw')} AS parsed_code, {_DBL.format('double_raw')} AS parsed_double
FROM ({X.DIRTY}) d""")
def parse_values(spark, sf):
    d = X.dirty(spark, sf)
    return d.select("event_id", safe_ts(F.col("pickup_raw")).alias("parsed_ts"), safe_long(F.col("long_raw")).alias("parsed_long"),
                    safe_code(F.col("long_raw")).alias("parsed_code"), safe_double(F.col("double_raw")).alias("parsed_double"))


@query("landing_records", f"""
SELECT event_id, to_json({{'cents_raw': cents_raw, 'double_raw': double_raw, 'long_raw': long_raw,
  'pickup_raw': pickup_raw, 'second_raw': second_raw}})::varchar AS raw_record_json FROM ({X.DIRTY}) d""")
def landing_records(spark, sf):
    source = X.dirty(spark, sf).withColumnsRenamed({"long_raw": "LongRaw", "pickup_raw": "pickupRaw"})
    named = normalize_columns(source)
    return named.select("event_id", raw_record_json(named.drop("event_id")).alias("raw_record_json"))


def raw_trips(spark, sf):
    """Dirty events under source spelling, as a trip file would carry them."""
    return X.dirty(spark, sf).select(
        F.col("event_id").cast("string").alias("RecordID"), F.col("pickup_raw").alias("lpep_pickup_datetime"),
        F.col("second_raw").alias("tpep_pickup_datetime"), F.col("second_raw").alias("lpep_dropoff_datetime"),
        F.col("long_raw").alias("PULocationID"), F.col("long_raw").alias("DOLocationID"),
        F.col("long_raw").alias("VendorID"), F.col("double_raw").alias("tripDistance"),
        F.col("cents_raw").alias("fare_amount"), F.col("cents_raw").alias("total_amount"))


@query("bronze_typed_trips", f"""
WITH b AS (SELECT *, coalesce({_TS.format('pickup_raw')}, {_TS.format('second_raw')}) AS pickup_ts,
    {_TS.format('second_raw')} AS dropoff_ts FROM ({X.DIRTY}) d)
SELECT cast(event_id AS varchar) AS record_id, pickup_ts, dropoff_ts, {_CODE.format('long_raw')} AS pickup_location_id,
  {_CODE.format('long_raw')} AS dropoff_location_id, {_CODE.format('long_raw')} AS vendor_id,
  {_DBL.format('double_raw')} AS trip_distance, cast(cents_raw AS double) AS fare_amount,
  cast(NULL AS double) AS tip_amount, cast(coalesce(pickup_ts, dropoff_ts) AS date) AS event_date, 'run-1' AS run_id,
  'events@r1' AS source_uri, 'events' AS source_file
FROM b WHERE coalesce(pickup_ts, dropoff_ts) IS NOT NULL""")
def bronze_typed_trips(spark, sf):
    bronze = to_bronze(raw_trips(spark, sf), "run-1", "events@r1", "r1")
    return bronze.select("record_id", "pickup_ts", "dropoff_ts", "pickup_location_id", "dropoff_location_id", "vendor_id",
                         "trip_distance", "fare_amount", "tip_amount", "event_date", "run_id", "source_uri", "source_file")


# --- canonical trips ----------------------------------------------------------------------------

_ID_TEXT = ", ".join(f"coalesce(cast({c} AS varchar), '')" for c in S.TRIP_ID_FIELDS)
_NULLS = {"ratecode_id": "bigint", "passenger_count": "bigint"}
_AMOUNTS = ("tip_amount", "extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee")


def _canonical_sql() -> str:
    mapped = ", ".join([f"cast(NULL AS {t}) AS {c}" for c, t in _NULLS.items()]
                       + [f"cast(NULL AS double) AS {c}" for c in _AMOUNTS]
                       + ["cast(NULL AS bigint) AS trip_type", "cast(NULL AS varchar) AS store_and_fwd_flag"])
    columns = ", ".join(c for c in S.CANONICAL_COLUMNS)
    return f"""
WITH t AS (SELECT *, {mapped}, 'r1' AS source_revision, 'lines' AS source_uri, 'dataset' AS source_kind,
    dropoff_ts AS ingestion_ts, 'run-1' AS bronze_run_id, 'run-1' AS silver_run_id FROM ({X.LINE_TRIPS}) l),
k AS (SELECT *, sha256(concat_ws('||', {_ID_TEXT})) AS trip_id,
    {SEC.format('dropoff_ts')} - {SEC.format('pickup_ts')} AS trip_duration_seconds FROM t),
v AS (SELECT * FROM k WHERE pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
    AND trip_duration_seconds > 0 AND trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0
    QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY ingestion_ts DESC) = 1),
z AS (SELECT v.*, p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
    q.borough AS dropoff_borough, q.zone AS dropoff_zone, q.service_zone AS dropoff_service_zone,
    cast(pickup_ts AS date) AS pickup_date, cast(hour(pickup_ts) AS int) AS pickup_hour,
    cast(dayofweek(pickup_ts) + 1 AS int) AS pickup_dow, cast(month(pickup_ts) AS int) AS pickup_month,
    CASE WHEN dayofweek(pickup_ts) IN (0, 6) THEN 1 ELSE 0 END AS pickup_is_weekend,
    round(trip_duration_seconds / 60.0, 3) AS trip_duration_minutes
  FROM v LEFT JOIN ({X.ZONES}) p ON v.pickup_location_id = p.location_id
  LEFT JOIN ({X.ZONES}) q ON v.dropoff_location_id = q.location_id)
SELECT {columns} FROM z"""


@query("canonical_trips", _canonical_sql())
def canonical(spark, sf):
    trips = X.line_trips(spark, sf).withColumns({
        "run_id": F.lit("run-1"), "source_revision": F.lit("r1"), "source_uri": F.lit("lines"),
        "source_kind": F.lit("dataset"), "ingestion_ts": F.col("dropoff_ts")})
    return canonical_trips(trips, X.zones(spark, sf), "run-1")


@query("zone_roles_join", f"""
SELECT l.l_orderkey, l.l_linenumber, l.pickup_location_id, l.dropoff_location_id, p.borough AS pickup_borough,
  p.zone AS pickup_zone, p.service_zone AS pickup_service_zone, q.borough AS dropoff_borough, q.zone AS dropoff_zone,
  q.service_zone AS dropoff_service_zone
FROM ({X.LINE_TRIPS}) l LEFT JOIN ({X.ZONES}) p ON l.pickup_location_id = p.location_id
LEFT JOIN ({X.ZONES}) q ON l.dropoff_location_id = q.location_id""")
def zone_roles_join(spark, sf):
    trips = X.line_trips(spark, sf).select("l_orderkey", "l_linenumber", "pickup_location_id", "dropoff_location_id")
    return attach_zone_roles(trips, X.zones(spark, sf))


@query("dedupe_latest", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST) = 1""")
def dedupe_latest_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    return dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey"])


@query("latest_by_key", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC, o_orderstatus DESC) = 1""")
def latest_order_by_customer(spark, sf):
    return latest_by_key(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey")


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_line_keys(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_count", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicate_rows FROM lineitem")
def duplicate_orders(spark, sf):
    return duplicate_count(table(spark, sf, "lineitem"), "l_orderkey")


@query("join_coverage", f"""
WITH z AS (SELECT location_id FROM ({X.ZONES}) WHERE borough IS NOT NULL),
k AS (SELECT 'pickup_location_id' AS key_column, pickup_location_id AS v FROM ({X.LINE_TRIPS}) a
  UNION ALL SELECT 'dropoff_location_id', dropoff_location_id FROM ({X.LINE_TRIPS}) b)
SELECT key_column, count(*) AS n_rows, count(*) FILTER (v IS NULL) AS null_keys,
  count(*) FILTER (v IS NOT NULL AND location_id IS NULL) AS unmatched
FROM k LEFT JOIN z ON v = location_id GROUP BY 1""")
def line_join_coverage(spark, sf):
    named = X.zones(spark, sf).where(F.col("borough").isNotNull())
    return join_coverage(X.line_trips(spark, sf), named, ["pickup_location_id", "dropoff_location_id"])


# --- codes ----------------------------------------------------------------------------------------

_BOROUGH_SQL = ("CASE lower(trim(coalesce({0}, ''))) "
                + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.BOROUGH_CODES.items()) + " ELSE 0 END")


@query("category_codes", f"""
SELECT l_orderkey, l_linenumber, {_BOROUGH_SQL.format('p.borough')} AS pickup_borough_id,
  {_BOROUGH_SQL.format('q.borough')} AS dropoff_borough_id
FROM ({X.LINE_TRIPS}) l LEFT JOIN ({X.ZONES}) p ON l.pickup_location_id = p.location_id
LEFT JOIN ({X.ZONES}) q ON l.dropoff_location_id = q.location_id""")
def category_codes(spark, sf):
    trips = X.line_trips(spark, sf).select("l_orderkey", "l_linenumber", "pickup_location_id", "dropoff_location_id")
    joined = attach_zone_roles(trips, X.zones(spark, sf))
    return joined.select("l_orderkey", "l_linenumber", *[
        fixed_code(F.col(f"{r}_borough"), S.BOROUGH_CODES).alias(f"{r}_borough_id") for r in ("pickup", "dropoff")])


@query("versioned_lookup", """
WITH v AS (SELECT DISTINCT lower(trim(coalesce(x, ''))) AS value FROM
  (SELECT p_name AS x FROM part UNION ALL SELECT p_brand FROM part))
SELECT value, cast(row_number() OVER (ORDER BY value) AS int) AS code FROM v WHERE value NOT IN ('', 'unknown')""")
def versioned_lookup(spark, sf):
    return sorted_codes(table(spark, sf, "part"), ["p_name", "p_brand"])


@query("url_codes", """
SELECT value AS url, cast(row_number() OVER (ORDER BY value) AS int) AS code FROM (
  SELECT DISTINCT lower(trim(coalesce(url, ''))) AS value FROM pages) WHERE value NOT IN ('', 'unknown')""")
def url_codes(spark, sf):
    """Codes of very many values that begin alike."""
    return sorted_codes(table(spark, sf, "pages"), ["url"]).withColumnRenamed("value", "url")


@query("route_bucket", f"""
SELECT event_id, {_route('pickup_zone_id', 'dropoff_zone_id')} AS route_pair_id FROM ({X.EVENT_TRIPS}) e""")
def route_buckets(spark, sf):
    return X.event_trips(spark, sf).select("event_id", route_bucket(
        F.col("pickup_zone_id"), F.col("dropoff_zone_id"), S.ROUTE_SALT, S.ROUTE_BUCKETS).alias("route_pair_id"))


# --- trailing windows ---------------------------------------------------------------------------

@query("trailing_7d_duration", f"""
SELECT event_id, avg({S.LABEL}) OVER {_frame('pickup_zone_id, pickup_hour', 'pickup_ts', 7 * S.DAY)} AS avg_duration_7d
FROM ({X.EVENT_TRIPS}) e""")
def trailing_7d_duration(spark, sf):
    spec = Trailing("avg_duration_7d", ("pickup_zone_id", "pickup_hour"), 7 * S.DAY, "avg", S.LABEL)
    return trailing_features(X.event_trips(spark, sf), epoch_second(F.col("pickup_ts")), [spec]).select("event_id", spec.name)


@query("trailing_30d_fare", f"""
SELECT event_id, avg(fare_amount) OVER {_frame('pickup_zone_id', 'pickup_ts', 30 * S.DAY)} AS avg_fare_30d,
  sum(fare_amount) OVER {_frame('pickup_zone_id', 'pickup_ts', S.DAY)} AS sum_fare_1d FROM ({X.EVENT_TRIPS}) e""")
def trailing_30d_fare(spark, sf):
    specs = [Trailing("avg_fare_30d", ("pickup_zone_id",), 30 * S.DAY, "avg", "fare_amount"),
             Trailing("sum_fare_1d", ("pickup_zone_id",), S.DAY, "sum", "fare_amount")]
    featured = trailing_features(X.event_trips(spark, sf), epoch_second(F.col("pickup_ts")), specs)
    return featured.select("event_id", "avg_fare_30d", "sum_fare_1d")


@query("trailing_90d_count", f"""
SELECT l_orderkey, l_linenumber, cast(count(*) OVER {_frame('pickup_location_id', 'pickup_ts', 90 * S.DAY)} AS double) AS n_90d,
  avg(trip_distance) OVER {_frame('pickup_location_id, source_file', 'pickup_ts', 7 * S.DAY)} AS avg_distance_7d
FROM ({X.LINE_TRIPS}) l""")
def trailing_90d_count(spark, sf):
    specs = [Trailing("n_90d", ("pickup_location_id",), 90 * S.DAY, "count", None, 0.0),
             Trailing("avg_distance_7d", ("pickup_location_id", "source_file"), 7 * S.DAY, "avg", "trip_distance")]
    featured = trailing_features(X.line_trips(spark, sf), epoch_second(F.col("pickup_ts")), specs)
    return featured.select("l_orderkey", "l_linenumber", "n_90d", "avg_distance_7d")


# --- matrix ---------------------------------------------------------------------------------------

def _matrix_sql(silver: str, min_label: float = 1.0, id_sql: str = "trip_id") -> str:
    norm = "lower(trim(coalesce({0}, '')))"
    code = ("coalesce((SELECT code FROM codes WHERE value = " + norm + "), 0)")
    return f"""
WITH s AS ({silver}),
codes AS (SELECT value, cast(row_number() OVER (ORDER BY value) AS int) AS code FROM (
  SELECT DISTINCT {norm.format('x')} AS value FROM (SELECT pickup_service_zone AS x FROM s UNION ALL SELECT dropoff_service_zone FROM s))
  WHERE value NOT IN ('', 'unknown')),
b AS (SELECT *, cast(coalesce(pickup_location_id, 0) AS int) AS pickup_zone_id,
  cast(coalesce(dropoff_location_id, 0) AS int) AS dropoff_zone_id, cast(hour(pickup_ts) AS int) AS pickup_hour,
  cast(trip_duration_seconds AS double) AS label FROM s),
w AS (SELECT *, avg(label) OVER {_frame('pickup_zone_id, pickup_hour', 'pickup_ts', 7 * S.DAY)} AS a7,
  avg(fare_amount) OVER {_frame('pickup_zone_id', 'pickup_ts', 30 * S.DAY)} AS a30,
  cast(count(*) OVER {_frame('pickup_zone_id, pickup_hour', 'pickup_ts', 90 * S.DAY)} AS double) AS n90 FROM b)
SELECT {id_sql} AS trip_id, pickup_ts, pickup_ts AS as_of_ts, cast(pickup_ts AS date) AS as_of_date,
  '{S.SCHEMA_VERSION}' AS schema_version, '{S.FEATURE_VERSION}' AS feature_version, pickup_hour,
  cast(dayofweek(pickup_ts) + 1 AS int) AS pickup_dow, cast(month(pickup_ts) AS int) AS pickup_month,
  CASE WHEN dayofweek(pickup_ts) IN (0, 6) THEN 1 ELSE 0 END AS pickup_is_weekend,
  {_BOROUGH_SQL.format('pickup_borough')} AS pickup_borough_id, pickup_zone_id,
  {code.format('pickup_service_zone')} AS pickup_service_zone_id,
  {_BOROUGH_SQL.format('dropoff_borough')} AS dropoff_borough_id, dropoff_zone_id,
  {code.format('dropoff_service_zone')} AS dropoff_service_zone_id,
  {_route('pickup_zone_id', 'dropoff_zone_id')} AS route_pair_id,
  a7 AS avg_duration_7d_zone_hour, a30 AS avg_fare_30d_zone, n90 AS trip_count_90d_zone_hour, label AS {S.LABEL}
FROM w WHERE label >= {min_label}"""


@query("frozen_matrix", _matrix_sql(X.SILVER))
def frozen_matrix(spark, sf):
    silver = X.silver(spark, sf)
    out = training_matrix(silver, service_zone_values(silver))
    return cold_start_to_null(out, "avg_duration_7d_zone_hour", "avg_fare_30d_zone")


def _elt_sources(spark, sf):
    trips = X.event_trips(spark, sf).select(
        F.col("pickup_ts").cast("string").alias("lpep_pickup_datetime"),
        F.col("dropoff_ts").cast("string").alias("lpep_dropoff_datetime"),
        F.col("pickup_zone_id").alias("PULocationID"), F.col("dropoff_zone_id").alias("DOLocationID"),
        F.col("event_id").alias("VendorID"), F.lit(1.0).alias("trip_distance"), "fare_amount",
        F.col("fare_amount").alias("total_amount"))
    return trips, X.zones(spark, sf).withColumnRenamed("location_id", "LocationID")


_ELT_MATRIX = _matrix_sql(
    f"SELECT * FROM ({X.SILVER}) WHERE trip_duration_seconds > 0")


@query("elt_matrix", f"SELECT * EXCLUDE (trip_id) FROM ({_ELT_MATRIX})")
def elt_matrix(spark, sf):
    """Raw text to published matrix through all three layers on disk."""
    trips, zones = _elt_sources(spark, sf)
    lake = Lake(spark, scratch_dir(spark, "lake"))
    run_elt(lake, trips, zones, "run-1", "events")
    out = lake.read(S.GOLD_MATRIX, S.MATRIX_COLUMNS).drop("trip_id")
    return cold_start_to_null(out, "avg_duration_7d_zone_hour", "avg_fare_30d_zone")


@query("matrix_label_filter", f"SELECT count(*) AS n_rows FROM ({X.MATRIX}) m WHERE {S.LABEL} >= 10 AND {S.LABEL} <= 2000")
def matrix_label_filter(spark, sf):
    return X.matrix(spark, sf).where(usable_label(10, 2000)).agg(F.count(F.lit(1)).alias("n_rows"))


@query("quality_summary", f"""
SELECT count(*) AS n_rows, count(*) - count(avg_duration_7d_zone_hour) AS avg_duration_7d_zone_hour_nulls,
  count(*) - count(avg_fare_30d_zone) AS avg_fare_30d_zone_nulls,
  count(*) - count(trip_count_90d_zone_hour) AS trip_count_90d_zone_hour_nulls FROM ({X.BROKEN_MATRIX}) m""")
def matrix_quality(spark, sf):
    return quality_summary(X.matrix(spark, sf, broken=True))


_DIGESTED = {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "l_returnflag": "l_returnflag",
             "l_linestatus": "l_linestatus", "l_shipdate": "cast(l_shipdate AS date)", "cents": "cast(round(l_extendedprice * 100) AS bigint)"}
_TEXTS = " || ".join(f"coalesce(length(cast({c} AS varchar)) || ':' || cast({c} AS varchar), '-')" for c in _DIGESTED)


@query("table_digest", f"""
WITH l AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _DIGESTED.items())} FROM lineitem), m AS (SELECT md5({_TEXTS}) AS h FROM l),
w AS (SELECT cast('0x' || substr(h, 1, 16) AS ubigint) AS hi, cast('0x' || substr(h, 17, 16) AS ubigint) AS lo FROM m)
SELECT count(*) AS n_rows, cast(cast(sum(hi) AS decimal(38,0)) % 18446744073709551616 AS varchar) AS sum_hi,
  cast(cast(sum(lo) AS decimal(38,0)) % 18446744073709551616 AS varchar) AS sum_lo,
  lpad(lower(to_hex(bit_xor(hi))), 16, '0') AS xor_hi, lpad(lower(to_hex(bit_xor(lo))), 16, '0') AS xor_lo FROM w""")
def lineitem_digest(spark, sf):
    """Digests by ship month, merged to that of the whole table."""
    lines = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _DIGESTED.items()])
    by_month = table_digest(lines.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")), list(_DIGESTED), ["month"])
    return merge_digests(by_month)
