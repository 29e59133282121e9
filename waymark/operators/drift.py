"""Population stability index per column and the drift report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.operators.ranking import exact_quantiles, sql_double

FLOOR = 1e-4
DECILES = [i / 10 for i in range(1, 10)]


def decile_edges(reference: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Distinct inner decile edges of the reference side; NULL and NaN left out."""
    if not columns:
        return {}
    edges = exact_quantiles(reference, {c: F.col(c) for c in columns}, DECILES)
    return {c: sorted({e for e in v if e is not None}) for c, v in edges.items()}


def _bins(df: DataFrame, categorical: Sequence[str], edges: dict[str, list[float]], side: str) -> DataFrame:
    binned = [f"coalesce(cast(`{c}` AS string), '<null>') AS `{c}`" for c in categorical]
    for c, cuts in edges.items():
        place = " + ".join(["0", *[f"cast(`{c}` > {sql_double(e)} AS int)" for e in cuts]])
        binned.append(f"CASE WHEN NOT isnan(`{c}`) THEN cast({place} AS string) END AS `{c}`")
    columns = [*categorical, *edges]
    return (
        df.selectExpr(*binned).unpivot([], columns, "column_name", "bin")
        .groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias(side))
    )


def histograms(current: DataFrame, reference: DataFrame, categorical: Sequence[str], edges: dict[str, list[float]]) -> DataFrame:
    """Current and reference counts per column and bin; each side is combined before it meets the other."""
    a = _bins(current, categorical, edges, "n_current").withColumn("n_reference", F.lit(0).cast("bigint"))
    b = _bins(reference, categorical, edges, "n_reference").withColumn("n_current", F.lit(0).cast("bigint"))
    return (
        a.unionByName(b).groupBy("column_name", "bin")
        .agg(F.sum("n_current").alias("n_current"), F.sum("n_reference").alias("n_reference"))
    )


def psi(current: DataFrame, reference: DataFrame, categorical: Sequence[str] = S.CATEGORICAL_FEATURES,
        numeric: Sequence[str] = (*S.NUMERIC_FEATURES, S.LABEL), threshold: float = S.DRIFT_PSI_THRESHOLD) -> DataFrame:
    """PSI per column: ``sum((c - r) * ln(c / r))`` over bins, shares floored at 1e-4.

    Categorical bins are the values of either side; numeric bins are the reference
    deciles with open ends. Missing numbers are counted apart, not binned.
    """
    edges = decile_edges(reference, numeric)
    counts = histograms(current, reference, categorical, edges)
    totals = counts.where(F.col("bin").isNotNull()).groupBy("column_name").agg(
        F.sum("n_current").alias("_c"), F.sum("n_reference").alias("_r"))
    missing = counts.where(F.col("bin").isNull()).select(
        "column_name", F.col("n_current").alias("missing_current"), F.col("n_reference").alias("missing_reference"))
    share_c = F.greatest(F.col("n_current") / F.nullif(F.col("_c"), F.lit(0)), F.lit(FLOOR))
    share_r = F.greatest(F.col("n_reference") / F.nullif(F.col("_r"), F.lit(0)), F.lit(FLOOR))
    scores = (
        counts.where(F.col("bin").isNotNull()).join(totals, "column_name")
        .groupBy("column_name")
        .agg(F.sum((share_c - share_r) * F.ln(share_c / share_r)).alias("psi"), F.count(F.lit(1)).alias("n_bins"))
    )
    return scores.join(missing, "column_name", "left").select(
        "column_name",
        F.when(F.col("column_name").isin(*numeric), "numeric").otherwise("categorical").alias("kind"),
        "n_bins", "psi",
        F.coalesce("missing_current", F.lit(0)).alias("missing_current"),
        F.coalesce("missing_reference", F.lit(0)).alias("missing_reference"),
        (F.col("psi") >= threshold).alias("drifted"),
    )


def drift_report(scores: DataFrame, current_rows: int, reference_rows: int, order: Sequence[str],
                 share_threshold: float = S.DRIFT_SHARE, snapshot_id: str | None = None) -> DataFrame:
    """One row over the per-column scores (one row per monitored column)."""
    place = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("column_name"))
    drifted = F.sort_array(F.collect_list(F.when(F.col("drifted"), F.struct(place.alias("p"), "column_name"))))
    share = F.count(F.when(F.col("drifted"), 1)) / F.count(F.lit(1))
    return scores.agg(
        F.lit(current_rows).cast("bigint").alias("current_rows"),
        F.lit(reference_rows).cast("bigint").alias("reference_rows"),
        F.count(F.lit(1)).alias("monitored_columns"),
        F.transform(drifted, lambda s: s["column_name"]).alias("drifted_columns"),
        F.count(F.when(F.col("drifted"), 1)).alias("drifted_columns_count"),
        share.alias("drift_share"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("any_drift"),
        (share >= share_threshold).alias("share_drift"),
        F.lit(S.SCHEMA_VERSION).alias("schema_version"),
        F.lit(S.FEATURE_VERSION).alias("feature_version"),
        F.lit(snapshot_id).cast("string").alias("reference_snapshot_id"),
    )
