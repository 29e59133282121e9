"""Label statistics, target transform and regression errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.parsing import clip
from waymark.operators.ranking import exact_quantiles
from waymark.session import materialize
from waymark.settings import LABEL_CAP_QUANTILE


def label_cap(df: DataFrame, label: str, quantile: float = LABEL_CAP_QUANTILE) -> tuple[float, float]:
    """The label cap (interpolated quantile) and the median of the capped labels.

    Both come from order statistics of the raw labels: clipping keeps the order.
    """
    cap, median = exact_quantiles(df, {label: F.col(label)}, [quantile, 0.5])[label]
    if cap is None:
        raise ValueError(f"{label} holds no values")
    return cap, min(max(median, 0.0), cap)


def to_log_target(seconds: Column, cap: float | Column) -> Column:
    return F.log1p(clip(seconds.cast("double"), 0.0, cap))


def from_log_target(value: Column, cap: float | Column) -> Column:
    """Back to seconds, held inside ``[0, cap]``."""
    return clip(F.expm1(value), 0.0, cap)


def error_columns(actual: Column, predicted: Column, suffix: str) -> list[Column]:
    gap = predicted - actual
    return [F.avg(F.abs(gap)).alias(f"mae_seconds_{suffix}"),
            F.sqrt(F.avg(gap * gap)).alias(f"rmse_seconds_{suffix}")]


def error_metrics(df: DataFrame, actual: str, predicted: str, cap: float) -> DataFrame:
    """MAE, RMSE and median absolute error against raw and capped labels, in one row.

    The pairs are stored first: the median needs several passes, and predictions
    are costly to compute again.
    """
    df = materialize(df.select(F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p")), "errors")
    y, p = F.col("y"), F.col("p")
    capped = clip(y, 0.0, float(cap))
    medians = exact_quantiles(df, {"raw": F.abs(p - y), "capped": F.abs(p - capped)}, [0.5])
    if medians["raw"][0] is None:
        raise ValueError("nothing to evaluate")
    return df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        *error_columns(y, p, "raw"), *error_columns(capped, p, "capped"),
        F.lit(medians["raw"][0]).alias("medae_seconds_raw"),
        F.lit(medians["capped"][0]).alias("medae_seconds_capped"),
    )


def baseline_metrics(train: DataFrame, holdout: DataFrame, label: str, quantile: float = LABEL_CAP_QUANTILE) -> DataFrame:
    """Errors on the capped holdout labels of always predicting the capped train median."""
    cap, median = label_cap(train, label, quantile)
    actual = clip(F.col(label).cast("double"), 0.0, cap)
    medae = exact_quantiles(holdout, {"gap": F.abs(F.lit(median) - actual)}, [0.5])["gap"][0]
    gap = F.lit(median) - actual
    return holdout.agg(
        F.lit(cap).alias("label_cap"), F.lit(median).alias("train_median"),
        F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.lit(medae).alias("medae"),
    )


def prediction_parity(left: DataFrame, right: DataFrame, key: str, value: str, rows: int | None, tolerance: float) -> DataFrame:
    """Largest absolute gap between two scored frames on the same keys.

    ``rows`` keeps the first rows by key, as the export check does; ``None``
    compares everything.
    """
    if rows is not None:
        left = left.orderBy(key).limit(rows)
    pairs = left.select(key, F.col(value).alias("_a")).join(right.select(key, F.col(value).alias("_b")), key, "left")
    gap = F.abs(F.col("_a") - F.col("_b"))
    return pairs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("_b").isNull(), 1)).alias("unmatched"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("max_abs_gap"),
        (F.coalesce(F.max(gap), F.lit(0.0)) <= tolerance).alias("within_tolerance"),
    )
