"""Dimension joins and category codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.parsing import norm_text
from waymark.operators.ranking import range_positions
from waymark.session import broadcast_if_small


def attach_role(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Left join of the zone columns under a role prefix (``pickup``, ``dropoff``)."""
    side = zones.select(
        F.col("location_id").alias("_location"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )
    return trips.join(side, F.col(f"{role}_location_id") == F.col("_location"), "left").drop("_location")


def attach_zone_roles(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Both zone roles; the lookup is broadcast when a count shows it is small."""
    side = broadcast_if_small(zones.select("location_id", "borough", "zone", "service_zone"))
    return attach_role(attach_role(trips, side, "pickup"), side, "dropoff")


def join_coverage(trips: DataFrame, zones: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per key column: rows, NULL keys and rows without a partner."""
    side = broadcast_if_small(zones.select(F.col("location_id").alias("_location")).distinct()
                              .withColumn("_hit", F.lit(1)))
    # Counts per distinct key first: the join then runs on a few rows.
    keys = (
        trips.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
        .unpivot([], list(columns), "key_column", "key_value")
        .groupBy("key_column", "key_value").agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        keys.join(side, F.col("key_value") == F.col("_location"), "left")
        .groupBy("key_column")
        .agg(
            F.sum("_n").alias("n_rows"),
            F.sum(F.when(F.col("key_value").isNull(), F.col("_n")).otherwise(0)).alias("null_keys"),
            F.sum(F.when(F.col("key_value").isNotNull() & F.col("_hit").isNull(), F.col("_n")).otherwise(0))
            .alias("unmatched"),
        )
    )


def fixed_code(value: Column, codes: dict[str, int], unknown: int = 0) -> Column:
    """Code of a normalised text from a small fixed table."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(table, norm_text(value)), F.lit(unknown)).cast("int")


def category_values(df: DataFrame, columns: Sequence[str], exclude: Sequence[str] = ("", "unknown")) -> DataFrame:
    """Distinct normalised values over ``columns``, in one scan."""
    values = df.select(F.explode(F.array(*[norm_text(F.col(c)) for c in columns])).alias("value"))
    return values.where(~F.col("value").isin(*exclude)).distinct()


def sorted_codes(df: DataFrame, columns: Sequence[str], exclude: Sequence[str] = ("", "unknown")) -> DataFrame:
    """Distinct normalised values over ``columns``, numbered 1..n in sorted order."""
    placed = range_positions(category_values(df, columns, exclude), ["value"])
    return placed.select("value", (F.col("position") + 1).cast("int").alias("code"))


def attach_codes(df: DataFrame, codes: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``columns[c]`` with the code of text column ``c``; 0 when unknown."""
    side = broadcast_if_small(codes)
    for source, target in columns.items():
        named = side.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = (
            df.join(named, norm_text(F.col(source)) == F.col("_value"), "left")
            .withColumn(target, F.coalesce(F.col("_code"), F.lit(0)).cast("int"))
            .drop("_value", "_code")
        )
    return df
