"""The versioned contract that travels with the training matrix."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.columns import computed_once
from waymark.functions.hashing import canonical_json, canonical_json_text, schema_hash

# The published feature table (name, role, dtype, nullable, unit, missing policy).
_FEATURE_TABLE = (
    ("trip_id", "metadata", "string", False, "identifier", "required"),
    ("pickup_ts", "metadata", "timestamp", False, "timestamp_utc", "required"),
    ("as_of_ts", "metadata", "timestamp", False, "timestamp_utc", "required"),
    ("as_of_date", "metadata", "date", False, "date_utc", "required"),
    ("schema_version", "metadata", "string", False, "version_tag", "required"),
    ("feature_version", "metadata", "string", False, "version_tag", "required"),
    ("pickup_hour", "feature", "int32", False, "hour_0_23", "required"),
    ("pickup_dow", "feature", "int32", False, "dayofweek_1_sun_7_sat", "required"),
    ("pickup_month", "feature", "int32", False, "month_1_12", "required"),
    ("pickup_is_weekend", "feature", "int32", False, "boolean_0_1", "required"),
    ("pickup_borough_id", "feature", "int32", False, "categorical_id", "0_unknown"),
    ("pickup_zone_id", "feature", "int32", False, "taxi_zone_location_id", "0_unknown"),
    ("pickup_service_zone_id", "feature", "int32", False, "categorical_id", "0_unknown"),
    ("dropoff_borough_id", "feature", "int32", False, "categorical_id", "0_unknown"),
    ("dropoff_zone_id", "feature", "int32", False, "taxi_zone_location_id", "0_unknown"),
    ("dropoff_service_zone_id", "feature", "int32", False, "categorical_id", "0_unknown"),
    ("route_pair_id", "feature", "int32", False, "hashed_bucket", "0_unknown"),
    ("avg_duration_7d_zone_hour", "feature", "float64", True, "seconds", "nan_on_cold_start"),
    ("avg_fare_30d_zone", "feature", "float64", True, "currency_amount", "nan_on_cold_start"),
    ("trip_count_90d_zone_hour", "feature", "float64", False, "count", "0_on_cold_start"),
    ("label_trip_duration_seconds", "label", "float64", False, "seconds", "drop_row_if_null"),
)
_HASH = {"hash_algorithm": "sha256", "hash_salt": S.ROUTE_SALT, "bucket_count": S.ROUTE_BUCKETS}


def feature_spec(service_zones: Sequence[str]) -> list[dict]:
    names = ("name", "role", "dtype", "nullable", "unit", "missing_policy")
    rows = [dict(zip(names, r, strict=True)) for r in _FEATURE_TABLE]
    # Published category domains.
    domains = {
        "borough_id": list(range(7)),
        "service_zone_id": list(range(len(service_zones) + 1)),
        "route_pair_id": list(range(S.ROUTE_BUCKETS + 1)),
        "zone_id": "positive_location_ids_and_0_unknown",
    }
    for row in rows:
        name = row["name"]
        if name == S.LABEL:
            row["target_metric"] = "mae"
        if row["missing_policy"] == "0_unknown":
            row["categorical_feature"] = True
            row["domain"] = next(d for suffix, d in domains.items() if name.endswith(suffix))
        if name == "route_pair_id":
            row.update(_HASH)
    return rows


def encoding_spec(service_zones: Sequence[str]) -> dict:
    # Published texts of the encoding description.
    spec = {}
    for role in ("pickup", "dropoff"):
        spec[f"{role}_borough_id"] = {"type": "fixed_enum", "unknown": 0, "values": dict(S.BOROUGH_NAMES)}
        spec[f"{role}_zone_id"] = {"type": "identity_code", "unknown": 0, "source": f"silver.{role}_location_id",
                                   "note": "stable taxi zone location IDs"}
        spec[f"{role}_service_zone_id"] = {"type": "versioned_lookup", "unknown": 0,
                                           "source": f"silver.{role}_service_zone",
                                           "values": {i: v for i, v in enumerate(service_zones, 1)}}
    spec["route_pair_id"] = {"type": "hashed_bucket", "unknown": 0, **_HASH}
    return spec


def aggregate_spec(source_table: str) -> list[dict]:
    # Name, source column, days, grouping keys, fallback.
    table = (
        ("avg_duration_7d_zone_hour", S.LABEL, 7, ["pickup_zone_id", "pickup_hour"], "NaN"),
        ("avg_fare_30d_zone", "fare_amount", 30, ["pickup_zone_id"], "NaN"),
        ("trip_count_90d_zone_hour", "count(*)", 90, ["pickup_zone_id", "pickup_hour"], "0"),
    )
    return [
        {"name": name, "source_table": source_table, "source_column": column,
         "filter_predicate": f"pickup_ts in [as_of_ts - {days}d, as_of_ts)", "window_length": f"{days}d",
         "grouping_keys": keys, "minimum_history_rule": f"no prior rows => {fallback}", "null_fallback": fallback}
        for name, column, days, keys, fallback in table
    ]


def label_spec(source_table: str) -> dict:
    # Published label description.
    return {"name": S.LABEL, "dtype": "float64", "unit": "seconds", "source_table": source_table,
            "source_column": "trip_duration_seconds", "null_policy": "drop_row_if_null", "primary_metric": "mae",
            "secondary_metric": "rmse", "target_family": "eta"}


def build_contract(spark: SparkSession, *, run_id: str, gold_table: str, silver_table: str, snapshot_id: str,
                   rows: int, service_zones: Sequence[str], created_ts: datetime) -> DataFrame:
    """The one contract row for a finished matrix."""
    spec = feature_spec(service_zones)
    values = {
        "run_id": run_id, "feature_version": S.FEATURE_VERSION, "schema_version": S.SCHEMA_VERSION,
        "schema_hash": schema_hash(spec), "model_family": S.MODEL_FAMILY, "inference_runtime": S.INFERENCE_RUNTIME,
        "gold_table": gold_table, "source_silver_table": silver_table, "source_silver_snapshot_id": snapshot_id,
        "training_row_count": rows, "output_columns_json": canonical_json(list(S.MATRIX_COLUMNS)),
        "feature_spec_json": canonical_json({"schema_version": S.SCHEMA_VERSION,
                                             "feature_version": S.FEATURE_VERSION, "output_columns": spec}),
        "encoding_spec_json": canonical_json(encoding_spec(service_zones)),
        "aggregate_spec_json": canonical_json(aggregate_spec(silver_table)),
        "label_spec_json": canonical_json(label_spec(silver_table)),
        "created_ts": created_ts.replace(tzinfo=None),
    }
    return spark.createDataFrame([tuple(values[c] for c in S.CONTRACT_COLUMNS)], S.CONTRACT_SCHEMA)


def latest_contract(contracts: DataFrame, key: str = "feature_version") -> DataFrame:
    """The newest row per feature version, combined on the map side."""
    rest = [c for c in contracts.columns if c != "created_ts"]
    newest = contracts.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct("created_ts", *rest)).alias("_row"))
    return newest.select(*[F.col(f"_row.{c}").alias(c) for c in contracts.columns])


def current_snapshot(history: DataFrame, table: str | None = None) -> DataFrame:
    """Snapshot id of the newest current ancestor per table."""
    rows = history.where(F.col("is_current_ancestor"))
    if table is not None:
        rows = rows.where(F.col("table_id") == table)
    return rows.groupBy("table_id").agg(
        F.max(F.struct("made_current_at", "snapshot_id")).getField("snapshot_id").alias("snapshot_id"),
        F.max("made_current_at").alias("made_current_at"),
    )


def pin_snapshot(history: DataFrame, table: str, expected: str | None = None) -> str:
    """The current snapshot id; an error when a pinned id is no longer current."""
    row = current_snapshot(history, table).first()
    if row is None or row["snapshot_id"] is None:
        raise ValueError(f"{table} has no current snapshot")
    if expected and expected != row["snapshot_id"]:
        raise ValueError(f"{table} moved on: pinned {expected}, current {row['snapshot_id']}")
    return row["snapshot_id"]


def contract_violations(contracts: DataFrame) -> DataFrame:
    """Per row: which contract rules it breaks (an empty list is a good row)."""
    blank = [F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(f"blank {c}"))
             for c in S.CONTRACT_COLUMNS if c not in ("training_row_count", "created_ts")]
    unparsed = [F.when(F.try_parse_json(c).isNull(), F.lit(f"unreadable {c}")) for c in S.STABLE_JSON_FIELDS]
    columns = F.from_json("output_columns_json", "array<string>")
    checks = [
        *blank, *unparsed,
        F.when(~F.lower(F.trim("schema_hash")).rlike("^[0-9a-f]{64}$"), F.lit("schema_hash is not sha256 hex")),
        F.when(~columns.eqNullSafe(F.array(*[F.lit(c) for c in S.MATRIX_COLUMNS])), F.lit("output columns differ")),
        F.when(~F.coalesce(F.col("training_row_count") > 0, F.lit(False)), F.lit("no training rows")),
        F.when(F.col("created_ts").isNull(), F.lit("null created_ts")),
    ]
    return contracts.select("run_id", "feature_version", F.array_compact(F.array(*checks)).alias("violations"))


def contract_conflicts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Fields on which a new contract contradicts the newest one of its version.

    Text must match exactly; JSON is compared as documents, so key order and
    spacing do not matter. One row per conflicting field.
    """
    old = latest_contract(existing).select(
        F.col("feature_version").alias("_version"),
        *[F.col(c).alias(f"_old_{c}") for c in (*S.STABLE_TEXT_FIELDS, *S.STABLE_JSON_FIELDS)])
    pairs = new.join(old, F.col("feature_version") == F.col("_version"))

    def differs(c: str):
        a, b = F.col(c), F.col(f"_old_{c}")
        if c in S.STABLE_JSON_FIELDS:
            ja, jb = canonical_json_text(a), canonical_json_text(b)
            return F.when(a == b, F.try_parse_json(a).isNull()).otherwise(
                ~F.coalesce(ja == jb, F.lit(False)))
        return ~a.eqNullSafe(b)

    fields = F.array_compact(F.array(*[
        F.when(differs(c), F.lit(c)) for c in (*S.STABLE_TEXT_FIELDS, *S.STABLE_JSON_FIELDS)]))
    found = computed_once(pairs, {"fields": fields})
    return found.select("run_id", "feature_version", F.explode("fields").alias("field"))


_SPEC_DDL = "struct<output_columns: array<struct<name: string, role: string, dtype: string, nullable: boolean, missing_policy: string>>>"
_AGG_DDL = "array<struct<name: string, source_column: string, window_length: string, grouping_keys: array<string>, null_fallback: string>>"
_ENC_DDL = "map<string, struct<type: string, unknown: int, source: string, hash_algorithm: string, hash_salt: string, bucket_count: int, values: map<string, string>>>"
_LABEL_DDL = "map<string, string>"


def explode_contract(contracts: DataFrame) -> DataFrame:
    """One row per described item: columns, encodings, encoded values, aggregates, label fields."""
    keys = [F.col("run_id"), F.col("feature_version")]

    def rows(kind: str, source, name, detail, extra=None) -> DataFrame:
        frame = contracts.select(*keys, source)
        return frame.select(*keys, F.lit(kind).alias("kind"), name.alias("name"), detail.alias("detail"),
                            (extra if extra is not None else F.lit(None).cast("string")).alias("extra"))

    spec = F.inline(F.from_json("feature_spec_json", _SPEC_DDL).getField("output_columns"))
    encodings = F.explode(F.from_json("encoding_spec_json", _ENC_DDL)).alias("enc_name", "enc")
    aggregates = F.inline(F.from_json("aggregate_spec_json", _AGG_DDL))
    labels = F.explode(F.from_json("label_spec_json", _LABEL_DDL)).alias("k", "v")
    values = contracts.select(*keys, encodings).select(
        *keys, "enc_name", F.explode("enc.values").alias("code", "text"))
    return (
        rows("column", spec, F.col("name"), F.col("dtype"), F.concat_ws("/", "role", "missing_policy"))
        .unionByName(rows("encoding", encodings, F.col("enc_name"), F.col("enc.type"), F.col("enc.source")))
        .unionByName(values.select(*keys, F.lit("value").alias("kind"), F.col("enc_name").alias("name"),
                                   F.col("code").alias("detail"), F.col("text").alias("extra")))
        .unionByName(rows("aggregate", aggregates, F.col("name"), F.col("window_length"),
                          F.concat_ws(",", "grouping_keys")))
        .unionByName(rows("label", labels, F.col("k"), F.col("v")))
    )
