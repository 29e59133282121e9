"""Landing rows to typed bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.columns import cast_if_present, computed_once, first_value, require_columns, require_non_empty
from waymark.functions.parsing import safe_code, safe_double, safe_ts
from waymark.functions.times import event_date, utc_wall
from waymark.operators.dedupe import latest_by_key
from waymark.sources.lake import Lake
from waymark.sources.readers import land_trips, land_zones


def with_lineage(df: DataFrame, *, run_id: str, source_uri: str, revision: str, kind: str, file: str) -> DataFrame:
    return df.withColumns({
        "ingestion_ts": utc_wall(F.current_timestamp()), "run_id": F.lit(run_id), "source_uri": F.lit(source_uri),
        "source_revision": F.lit(revision), "source_kind": F.lit(kind), "source_file": F.lit(file),
    })


def typed_trips(landed: DataFrame) -> DataFrame:
    """Typed times, zones, amounts and codes; rows without any readable date are dropped.

    Each time and zone takes the first candidate column that holds a readable value.
    """
    columns = {
        "pickup_ts": first_value(landed, S.PICKUP_CANDIDATES, safe_ts),
        "dropoff_ts": first_value(landed, S.DROPOFF_CANDIDATES, safe_ts),
        "pickup_location_id": first_value(landed, S.PICKUP_ZONE_CANDIDATES, safe_code),
        "dropoff_location_id": first_value(landed, S.DROPOFF_ZONE_CANDIDATES, safe_code),
    }
    columns |= {c: safe_double(F.col(c)) for c in S.AMOUNT_COLUMNS if c in landed.columns}
    columns |= {c: safe_code(F.col(c)) for c in S.CODE_COLUMNS if c in landed.columns}
    typed = cast_if_present(computed_once(landed, columns), {"store_and_fwd_flag": "string"})
    dated = typed.withColumn("event_date", event_date(F.col("pickup_ts"), F.col("dropoff_ts")))
    return require_columns(dated.where(F.col("event_date").isNotNull()),
                           ("trip_distance", "fare_amount", "total_amount"), "bronze trips")


def to_bronze(raw: DataFrame, run_id: str, source_uri: str, revision: str = "", kind: str = "dataset") -> DataFrame:
    return with_lineage(typed_trips(land_trips(raw)), run_id=run_id, source_uri=source_uri, revision=revision,
                        kind=kind, file=source_uri.split("@")[0])


def zones_to_bronze(raw: DataFrame, run_id: str, source_uri: str) -> DataFrame:
    landed = land_zones(raw)
    zones = landed.select(safe_code(F.col("location_id")).alias("location_id"), "borough", "zone", "service_zone",
                          "raw_record_json")
    return with_lineage(latest_by_key(zones, "location_id"), run_id=run_id, source_uri=source_uri, revision="",
                        kind="csv", file=source_uri)


def ingest(lake: Lake, trips: DataFrame, zones: DataFrame, *, run_id: str, trips_uri: str, zones_uri: str,
           revision: str = "") -> dict:
    """Load one run: earlier rows of the same run are replaced, others stay."""
    require_non_empty(trips, "trips source")
    require_non_empty(zones, "zones source")
    lake.ensure_namespaces()
    lake.drop_run(S.BRONZE_TRIPS, run_id)
    modes = {
        "trips": lake.append(to_bronze(trips, run_id, trips_uri, revision), S.BRONZE_TRIPS,
                             ("run_id", "event_date"), run_id),
        "zones": lake.overwrite_single_file(zones_to_bronze(zones, run_id, zones_uri), S.BRONZE_ZONES, run_id),
    }
    return {"run_id": run_id, "write_modes": modes}
