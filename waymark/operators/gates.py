"""Validation rules counted in one pass instead of one job per rule."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.columns import column_diff
from waymark.functions.parsing import is_bad_number, is_infinite
from waymark.functions.times import instants_to_utc_wall

Rules = dict[str, Column]


def _any(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _outside(column: str, low, high=None) -> Column:
    value = F.col(column)
    bad = value.isNull() | (value < low)
    return bad | (value > high) if high is not None else bad


def count_violations(df: DataFrame, rules: Rules, extra: Sequence[Column] = ()) -> DataFrame:
    """One row: the number of rows and, per rule, the rows that break it."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(rule, 1)).alias(name) for name, rule in rules.items()],
        *extra,
    )


def single_value(column: str, expected: str, name: str) -> Column:
    """1 when the column is not exactly ``expected`` on every row (NULL is a value)."""
    c = F.col(column)
    return (
        (F.count(F.when(c.isNull(), 1)) > 0) | (F.min(c) != F.max(c)) | (F.min(c) != F.lit(expected))
    ).cast("bigint").alias(name)


def require_clean(violations: DataFrame, label: str) -> dict:
    """Raise when a gate found rows that break a rule, or no rows at all."""
    row = violations.first().asDict()
    if not row["n_rows"]:
        raise ValueError(f"{label} has no rows")
    broken = {k: v for k, v in row.items() if k != "n_rows" and v}
    if broken:
        raise ValueError(f"{label} breaks {broken}")
    return row


def require_exact_columns(df: DataFrame, expected: Sequence[str], label: str) -> None:
    diff = column_diff(df.columns, expected)
    if not diff["order_matches"]:
        raise ValueError(f"{label} columns differ: {diff}")


def matrix_rules(n_service_zones: int, min_label: float = S.MIN_LABEL_SECONDS, max_label: float = S.MAX_LABEL_SECONDS,
                 buckets: int = S.ROUTE_BUCKETS) -> Rules:
    label = F.col(S.LABEL)
    ranges = {
        "pickup_hour": (0, 23), "pickup_dow": (1, 7), "pickup_month": (1, 12), "pickup_is_weekend": (0, 1),
        "pickup_borough_id": (0, 6), "dropoff_borough_id": (0, 6), "pickup_zone_id": (0, None),
        "dropoff_zone_id": (0, None), "pickup_service_zone_id": (0, n_service_zones),
        "dropoff_service_zone_id": (0, n_service_zones), "route_pair_id": (0, buckets),
        "trip_count_90d_zone_hour": (0, None),
    }
    rules = {
        "null_ts": F.col("pickup_ts").isNull() | F.col("as_of_ts").isNull(),
        "ts_mismatch": F.col("pickup_ts") != F.col("as_of_ts"),
        "date_mismatch": F.to_date("pickup_ts") != F.col("as_of_date"),
        "bad_trip_id": F.col("trip_id").isNull() | (F.length("trip_id") != 64),
        "bad_version": _any(*[F.col(c).isNull() | (F.col(c) != v) for c, v in (
            ("schema_version", S.SCHEMA_VERSION), ("feature_version", S.FEATURE_VERSION))]),
        "bad_label": is_bad_number(label) | (label < float(min_label)),
        "out_of_range": _any(*[_outside(c, *r) for c, r in ranges.items()]),
    }
    if max_label > 0:
        rules["label_too_large"] = label > float(max_label)
    return rules


def matrix_gate(df: DataFrame, n_service_zones: int, **limits) -> DataFrame:
    """All matrix rules plus duplicate ids, as one row of counts.

    The rules need no shuffle; only ``trip_id`` is shuffled, for the duplicates.
    """
    require_exact_columns(df, S.MATRIX_COLUMNS, "training matrix")
    repeated = df.groupBy("trip_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.count(F.when(F.col("_n") > 1, 1)))
    return count_violations(df, matrix_rules(n_service_zones, **limits)).withColumn("duplicate_ids", repeated.scalar())


def quality_summary(df: DataFrame, columns: Sequence[str] = S.NUMERIC_FEATURES) -> DataFrame:
    """Row count and NULLs per column (NaN is a legal cold-start value here)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in columns])


def contract_rules(contract: Mapping[str, Any]) -> Rules:
    """What the column list of a loaded contract promises: no NULL where it says so, codes inside their domains.

    A domain that is a whole range is compared by its ends, so its size does not matter; any other list by its values;
    a text says that every code from 0 on is allowed.
    """
    columns = json.loads(contract["feature_spec_json"])["output_columns"]

    def outside(column: dict) -> Column:
        domain, value = column["domain"], F.col(column["name"])
        if not isinstance(domain, list):
            return _outside(column["name"], 0)
        if sorted(domain) == list(range(min(domain), max(domain) + 1)):
            return _outside(column["name"], min(domain), max(domain))
        return F.coalesce(~value.isin(domain), F.lit(True))

    return {
        "null_declared": _any(*[F.col(c["name"]).isNull() for c in columns if not c["nullable"]]),
        "outside_domain": _any(F.lit(False), *[outside(c) for c in columns if "domain" in c]),
    }


def contract_gate(df: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """:func:`train_gate` by the versions, columns and domains of a loaded contract, still in one pass."""
    require_exact_columns(df, json.loads(contract["output_columns_json"]), "training matrix")
    return train_gate(df, contract["schema_version"], contract["feature_version"], contract_rules(contract))


def train_gate(df: DataFrame, schema_version: str = S.SCHEMA_VERSION, feature_version: str = S.FEATURE_VERSION,
               more: Rules | None = None) -> DataFrame:
    """The checks before training: contract columns, versions, ranges, labels, history features."""
    require_exact_columns(df, S.MATRIX_COLUMNS, "training matrix")
    required = [c for c in S.MATRIX_COLUMNS if c not in ("avg_duration_7d_zone_hour", "avg_fare_30d_zone")]
    non_negative = [c for c in S.FEATURES if c.endswith("_id")] + ["trip_count_90d_zone_hour"]
    history = ("avg_duration_7d_zone_hour", "avg_fare_30d_zone")
    not_nan = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in history}
    rules = {
        "date_mismatch": ~F.to_date("as_of_ts").eqNullSafe(F.col("as_of_date")),
        "null_required": _any(*[
            is_bad_number(F.col(c)) if c in (*S.NUMERIC_FEATURES, S.LABEL) else F.col(c).isNull() for c in required]),
        "bad_calendar": _any(_outside("pickup_hour", 0, 23), _outside("pickup_dow", 1, 7),
                             _outside("pickup_month", 1, 12), _outside("pickup_is_weekend", 0, 1)),
        "label_not_positive": ~F.coalesce((F.col(S.LABEL) > 0) & ~F.isnan(F.col(S.LABEL)), F.lit(False)),
        "negative_code": F.coalesce(_any(*[F.coalesce(F.col(c) < 0, F.lit(False)) for c in non_negative]), F.lit(False)),
        "negative_history": _any(*[F.coalesce(not_nan[c] < 0, F.lit(False)) for c in history]),
        "infinite_history": _any(*[is_infinite(F.col(c)) for c in history]),
    }
    return count_violations(df, rules | (more or {}), [
        single_value("schema_version", schema_version, "bad_schema_version"),
        single_value("feature_version", feature_version, "bad_feature_version"),
    ])


def drift_gate(df: DataFrame, schema_version: str = S.SCHEMA_VERSION, feature_version: str = S.FEATURE_VERSION) -> DataFrame:
    """The checks on both drift inputs. NaN history is legal (a cold start), NULL is not."""
    require_exact_columns(df, S.MATRIX_COLUMNS, "drift input")
    numeric = (*S.NUMERIC_FEATURES, S.LABEL)
    rules = {
        "null_id": F.col("trip_id").isNull(),
        "null_as_of_ts": F.col("as_of_ts").isNull(),
        "null_numeric": _any(*[F.col(c).isNull() for c in numeric]),
        "infinite_numeric": _any(*[is_infinite(F.col(c)) for c in numeric]),
        "label_not_positive": F.col(S.LABEL) <= 0,
    }
    return count_violations(df, rules, [
        single_value("schema_version", schema_version, "bad_schema_version"),
        single_value("feature_version", feature_version, "bad_feature_version"),
    ])


def model_input(df: DataFrame) -> DataFrame:
    """The features in contract order: categories as int, numbers as float."""
    return df.select(*[F.col(c).cast("int").alias(c) for c in S.CATEGORICAL_FEATURES],
                     *[F.col(c).cast("float").alias(c) for c in S.NUMERIC_FEATURES])


def training_frame(df: DataFrame) -> DataFrame:
    """Model input plus the label as float."""
    return df.select(*[F.col(c).cast("int").alias(c) for c in S.CATEGORICAL_FEATURES],
                     *[F.col(c).cast("float").alias(c) for c in (*S.NUMERIC_FEATURES, S.LABEL)])


def model_input_gate(df: DataFrame) -> DataFrame:
    """Rows that :func:`model_input` must not accept: NULL categories, infinite numbers."""
    return count_violations(df, {
        "null_category": _any(*[F.col(c).isNull() for c in S.CATEGORICAL_FEATURES]),
        "infinite_number": _any(*[is_infinite(F.col(c).cast("float")) for c in S.NUMERIC_FEATURES]),
    })


def coerce_matrix(df: DataFrame) -> DataFrame:
    """Known columns only, leniently typed: unreadable values become NULL."""
    types = {"trip_id": "string", "pickup_ts": "timestamp_ntz", "as_of_ts": "timestamp_ntz", "as_of_date": "date",
             "schema_version": "string", "feature_version": "string"}
    types.update({c: "bigint" for c in S.CATEGORICAL_FEATURES})
    types.update({c: "double" for c in (*S.NUMERIC_FEATURES, S.LABEL)})
    df = instants_to_utc_wall(df)
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) for c in S.MATRIX_COLUMNS if c in df.columns])
