"""Column lists, versions and thresholds shared by every stage.

Fixed values: tables, contracts and model inputs written by other parties carry
exactly these names, codes and versions, so they are stated here verbatim.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw landing fields -------------------------------------------------
RAW_TRIP_FIELDS = (
    "raw_record_json", "vendor_id",
    "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "lpep_pickup_datetime", "lpep_dropoff_datetime",
    "pickup_datetime", "dropoff_datetime", "pickup_ts", "dropoff_ts",
    "pulocation_id", "dolocation_id", "pickup_location_id", "dropoff_location_id",
    "passenger_count", "trip_distance", "ratecode_id", "store_and_fwd_flag",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "ehail_fee", "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "cbd_congestion_fee", "trip_type", "vendorname", "record_id",
    "vendor_id_2",
)
RAW_ZONE_FIELDS = ("raw_record_json", "location_id", "borough", "zone", "service_zone")

PICKUP_CANDIDATES = ("lpep_pickup_datetime", "tpep_pickup_datetime", "pickup_ts", "pickup_datetime")
DROPOFF_CANDIDATES = ("lpep_dropoff_datetime", "tpep_dropoff_datetime", "dropoff_ts", "dropoff_datetime")
PICKUP_ZONE_CANDIDATES = ("pulocation_id", "pickup_location_id")
DROPOFF_ZONE_CANDIDATES = ("dolocation_id", "dropoff_location_id")

AMOUNT_COLUMNS = (
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "ehail_fee", "improvement_surcharge", "total_amount", "congestion_surcharge",
    "cbd_congestion_fee", "airport_fee",
)
CODE_COLUMNS = ("vendor_id", "ratecode_id", "passenger_count", "payment_type", "trip_type")
LINEAGE_COLUMNS = ("run_id", "source_uri", "source_revision", "source_kind", "source_file", "ingestion_ts")

# --- Fixed values: canonical trip table -----------------------------------------------
TRIP_ID_FIELDS = (
    "pickup_ts", "dropoff_ts", "pickup_location_id", "dropoff_location_id", "vendor_id",
    "ratecode_id", "passenger_count", "payment_type", "trip_distance", "fare_amount",
    "total_amount", "source_revision", "source_file",
)
DEDUPE_ORDER = ("ingestion_ts", "pickup_ts", "dropoff_ts", "source_revision", "source_file", "source_uri")
CANONICAL_COLUMNS = (
    "trip_id", "pickup_date", "pickup_ts", "dropoff_ts", "pickup_hour", "pickup_dow",
    "pickup_month", "pickup_is_weekend", "trip_duration_seconds", "trip_duration_minutes",
    "pickup_location_id", "dropoff_location_id", "pickup_borough", "pickup_zone",
    "pickup_service_zone", "dropoff_borough", "dropoff_zone", "dropoff_service_zone",
    "vendor_id", "ratecode_id", "passenger_count", "payment_type", "trip_type",
    "store_and_fwd_flag", "trip_distance", "fare_amount", "tip_amount", "total_amount",
    "extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "cbd_congestion_fee", "source_uri", "source_revision", "source_file", "source_kind",
    "ingestion_ts", "bronze_run_id", "silver_run_id",
)

# --- Fixed values: training matrix ----------------------------------------------------
SCHEMA_VERSION = "trip_eta_frozen_matrix_v1"
FEATURE_VERSION = "trip_eta_lgbm_v1"
MODEL_FAMILY = "lightgbm"
INFERENCE_RUNTIME = "onnxruntime"
ROUTE_SALT = "trip_eta_route_pair_v1"
ROUTE_BUCKETS = 4096
MIN_LABEL_SECONDS = 1
MAX_LABEL_SECONDS = 0  # 0 = no upper limit

CATEGORICAL_FEATURES = (
    "pickup_hour", "pickup_dow", "pickup_month", "pickup_is_weekend", "pickup_borough_id",
    "pickup_zone_id", "pickup_service_zone_id", "dropoff_borough_id", "dropoff_zone_id",
    "dropoff_service_zone_id", "route_pair_id",
)
NUMERIC_FEATURES = ("avg_duration_7d_zone_hour", "avg_fare_30d_zone", "trip_count_90d_zone_hour")
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
LABEL = "label_trip_duration_seconds"
MATRIX_KEYS = ("trip_id", "pickup_ts", "as_of_ts", "as_of_date", "schema_version", "feature_version")
MATRIX_COLUMNS = MATRIX_KEYS + FEATURES + (LABEL,)

BOROUGH_CODES = {
    "unknown": 0, "manhattan": 1, "queens": 2, "brooklyn": 3, "bronx": 4,
    "staten island": 5, "ewr": 6,
}
BOROUGH_NAMES = {
    1: "Manhattan", 2: "Queens", 3: "Brooklyn", 4: "Bronx", 5: "Staten Island", 6: "EWR",
}

DAY = 86_400

# --- Fixed values: contract table -----------------------------------------------------
CONTRACT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), False) for n in (
        "run_id", "feature_version", "schema_version", "schema_hash", "model_family",
        "inference_runtime", "gold_table", "source_silver_table", "source_silver_snapshot_id")]
    + [T.StructField("training_row_count", T.LongType(), False)]
    + [T.StructField(n, T.StringType(), False) for n in (
        "output_columns_json", "feature_spec_json", "encoding_spec_json",
        "aggregate_spec_json", "label_spec_json")]
    + [T.StructField("created_ts", T.TimestampNTZType(), False)]
)
CONTRACT_COLUMNS = tuple(CONTRACT_SCHEMA.names)
STABLE_TEXT_FIELDS = (
    "feature_version", "schema_version", "model_family", "inference_runtime", "gold_table",
    "source_silver_table",
)
STABLE_JSON_FIELDS = (
    "output_columns_json", "feature_spec_json", "encoding_spec_json", "aggregate_spec_json",
    "label_spec_json",
)

# --- Fixed values: training and scoring -----------------------------------------------
TEST_START_DATE = "2025-01-07"
INNER_KEEP_FRACTION = 0.90
SEARCH_KEEP_FRACTION = 0.80
LABEL_CAP_QUANTILE = 0.99
MAX_PREDICTION_SECONDS = 86_400.0
MIN_FINAL_ROUNDS = 50
PARITY_ROWS = 128
PARITY_TOLERANCE = 1e-4
MAX_INSTANCES = 256
SLOW_REQUEST_MS = 500.0
DRIFT_PSI_THRESHOLD = 0.1
DRIFT_SHARE = 0.5

# --- Fixed values: tables and maintenance ---------------------------------------------
BRONZE_TRIPS = "bronze.trips_raw"
BRONZE_ZONES = "bronze.taxi_zone_lookup_raw"
SILVER_TRIPS = "silver.trip_canonical"
GOLD_MATRIX = "gold.trip_training_matrix"
GOLD_CONTRACTS = "gold.trip_training_contracts"
MANAGED_TABLES = (BRONZE_TRIPS, BRONZE_ZONES, SILVER_TRIPS, GOLD_MATRIX, GOLD_CONTRACTS)
EXPIRE_DAYS = 7
ORPHAN_DAYS = 3
RETAIN_LAST = 2
COMPACT_DAYS = 30
MIN_COMPACT_FILES = 2
TARGET_FILE_BYTES = 256 * 1024 * 1024
