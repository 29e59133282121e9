"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedupe_latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key by ``order`` descending, NULLs last.

    The remaining columns break ties, so the result does not depend on row
    placement. Filtering the row number right away lets Spark keep one row per key
    on the map side (``WindowGroupLimit``), so a hot key sends at most one row per
    input task through the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *rest)])
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def latest_by_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Deterministic form of ``dropDuplicates(key)``."""
    return dedupe_latest(df, key, [])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows after the first of each key; NULL keys count as one group."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
    )
