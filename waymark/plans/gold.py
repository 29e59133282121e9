"""Canonical trips to the frozen training matrix and its contract."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.columns import present, qualify, require_columns, require_non_empty
from waymark.functions.hashing import route_bucket
from waymark.functions.times import calendar_parts, epoch_second
from waymark.operators.contract import build_contract, contract_conflicts, pin_snapshot
from waymark.operators.gates import matrix_gate, require_clean
from waymark.operators.lookups import attach_codes, category_values, fixed_code
from waymark.operators.trailing import Trailing, trailing_features
from waymark.session import materialize
from waymark.sources.lake import Lake

RUN_COLUMNS = ("silver_run_id", "bronze_run_id", "run_id")
NAN = float("nan")
HISTORY_FEATURES = (
    Trailing("avg_duration_7d_zone_hour", ("pickup_zone_id", "pickup_hour"), 7 * S.DAY, "avg", S.LABEL, NAN),
    Trailing("avg_fare_30d_zone", ("pickup_zone_id",), 30 * S.DAY, "avg", "fare_amount", NAN),
    Trailing("trip_count_90d_zone_hour", ("pickup_zone_id", "pickup_hour"), 90 * S.DAY, "count", None, 0.0),
)
SERVICE_ZONE_COLUMNS = ("pickup_service_zone", "dropoff_service_zone")
MAX_SERVICE_ZONES = 100_000  # what one contract row can reasonably list


def filter_run(df: DataFrame, run_id: str) -> DataFrame:
    """Rows of one run, by the first run column the table has."""
    found = present(df, RUN_COLUMNS)
    if not found:
        raise ValueError(f"no run column among {RUN_COLUMNS}")
    return df.where(F.col(found[0]) == run_id)


def point_in_time_base(silver: DataFrame) -> DataFrame:
    """As-of columns, calendar parts, zone ids and the label."""
    pickup = F.col("pickup_ts")
    base = silver.select(
        "trip_id", "pickup_ts", "pickup_borough", "dropoff_borough", *SERVICE_ZONE_COLUMNS, "fare_amount",
        pickup.alias("as_of_ts"), F.to_date(pickup).alias("as_of_date"), *calendar_parts(pickup),
        F.coalesce(F.col("pickup_location_id").cast("int"), F.lit(0)).alias("pickup_zone_id"),
        F.coalesce(F.col("dropoff_location_id").cast("int"), F.lit(0)).alias("dropoff_zone_id"),
        F.col("trip_duration_seconds").cast("double").alias(S.LABEL),
    )
    return base.withColumns({"schema_version": F.lit(S.SCHEMA_VERSION), "feature_version": F.lit(S.FEATURE_VERSION)})


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn("route_pair_id", route_bucket(
        F.col("pickup_zone_id"), F.col("dropoff_zone_id"), S.ROUTE_SALT, S.ROUTE_BUCKETS))


def with_history(df: DataFrame) -> DataFrame:
    return trailing_features(df, epoch_second(F.col("as_of_ts")), HISTORY_FEATURES)


def usable_label(min_label: float = S.MIN_LABEL_SECONDS, max_label: float = S.MAX_LABEL_SECONDS):
    keep = (F.col("pickup_ts").isNotNull() & F.col("trip_id").isNotNull() & (F.col(S.LABEL) >= float(min_label)))
    return keep & (F.col(S.LABEL) <= float(max_label)) if max_label > 0 else keep


def service_zone_values(silver: DataFrame) -> list[str]:
    """The sorted service zones; they are all listed in the contract row."""
    rows = category_values(silver, SERVICE_ZONE_COLUMNS).limit(MAX_SERVICE_ZONES + 1).collect()
    if len(rows) > MAX_SERVICE_ZONES:
        raise ValueError(f"more than {MAX_SERVICE_ZONES} service zones cannot be listed in a contract")
    return sorted(r["value"] for r in rows)


def training_matrix(silver: DataFrame, service_zones: Sequence[str], min_label: float = S.MIN_LABEL_SECONDS,
                    max_label: float = S.MAX_LABEL_SECONDS) -> DataFrame:
    """The 21-column matrix of one run, given the sorted service zones.

    History is computed before the label filter: rows without a usable label still
    count as history of later rows.
    """
    base = with_route(point_in_time_base(silver)).withColumns({
        f"{role}_borough_id": fixed_code(F.col(f"{role}_borough"), S.BOROUGH_CODES) for role in ("pickup", "dropoff")})
    targets = {c: f"{c}_id" for c in SERVICE_ZONE_COLUMNS}
    table = silver.sparkSession.createDataFrame(list(zip(service_zones, range(1, len(service_zones) + 1))), "value string, code int")
    base = attach_codes(base, table, targets)
    return with_history(base).where(usable_label(min_label, max_label)).select(*S.MATRIX_COLUMNS)


def build_gold(lake: Lake, run_id: str, pinned_snapshot: str | None = None, now: datetime | None = None) -> dict:
    """Matrix and contract of one run: build, check, compare with the old contract, then publish.

    The matrix is written once to the shared folder, so the checks, the count and
    the publishing do not recompute the features.
    """
    snapshot = pin_snapshot(lake.history(), qualify(S.SILVER_TRIPS), pinned_snapshot)
    silver = require_columns(filter_run(lake.read(S.SILVER_TRIPS), run_id),
                             ("trip_id", "pickup_ts", "pickup_location_id", "dropoff_location_id", "pickup_borough",
                              "dropoff_borough", *SERVICE_ZONE_COLUMNS, "trip_duration_seconds", "fare_amount"),
                             "canonical trips")
    require_non_empty(silver, "canonical run")
    zones = service_zone_values(silver)
    matrix = materialize(training_matrix(silver, zones), "matrix")
    checked = require_clean(matrix_gate(matrix, len(zones)), "training matrix")
    contract = build_contract(
        lake.spark, run_id=run_id, gold_table=qualify(S.GOLD_MATRIX), silver_table=qualify(S.SILVER_TRIPS),
        snapshot_id=snapshot, rows=checked["n_rows"], service_zones=zones, created_ts=now or datetime.now(UTC))
    if lake.exists(S.GOLD_CONTRACTS):
        clashes = [r["field"] for r in contract_conflicts(lake.read(S.GOLD_CONTRACTS, S.CONTRACT_COLUMNS), contract).collect()]
        if clashes:
            raise ValueError(f"contract {S.FEATURE_VERSION} conflicts on {sorted(clashes)}")
    mode = lake.overwrite_partitions(matrix, S.GOLD_MATRIX, "as_of_date", run_id)
    contract_mode = lake.overwrite_partitions(contract, S.GOLD_CONTRACTS, "feature_version", run_id)
    return {"run_id": run_id, "rows": checked["n_rows"], "snapshot_id": snapshot, "service_zones": zones,
            "write_mode": f"{mode};contract={contract_mode}"}
