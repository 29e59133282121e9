"""Date-based splits, even sampling and category levels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymark.operators.ranking import bucket_offsets, global_position, range_positions
from waymark.session import BROADCAST_ROWS
from waymark.settings import INNER_KEEP_FRACTION, SEARCH_KEEP_FRACTION, TEST_START_DATE


def rows_per_date(df: DataFrame, column: str = "as_of_date") -> DataFrame:
    return df.groupBy(F.col(column).cast("date").alias(column)).agg(F.count(F.lit(1)).alias("n_rows"))


def split_by_date(df: DataFrame, start: str | date = TEST_START_DATE, column: str = "as_of_date",
                  check: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows before ``start`` and rows from ``start`` on; plain pruned filters."""
    day = F.lit(str(start)).cast("date")
    left, right = df.where(F.col(column) < day), df.where(F.col(column) >= day)
    if check:
        for name, side in (("train", left), ("test", right)):
            if side.isEmpty():
                raise ValueError(f"{name} side is empty for a split at {start}")
    return left, right


def fraction_cutoff(df: DataFrame, keep: float, column: str = "as_of_date") -> DataFrame:
    """One row: the first date whose cumulative rows reach the kept share.

    Never the last date, so the right side is not empty. With fewer than two dates
    the cutoff is NULL. The running sum is over one row per date.
    """
    if not 0.0 < keep < 1.0:
        raise ValueError("keep must lie strictly between 0 and 1")
    dates = rows_per_date(df, column)
    by_date = W.orderBy(column)
    everything = W.partitionBy()
    ranked = dates.select(
        F.col(column).alias("cutoff_date"),
        F.sum("n_rows").over(by_date).alias("cumulative"),
        F.sum("n_rows").over(everything).alias("total"),
        F.row_number().over(by_date).alias("place"),
        F.count(F.lit(1)).over(everything).alias("n_dates"),
    )
    # rint is round-half-to-even.
    target = F.greatest(F.lit(1), F.least(F.col("total") - 1, F.rint(F.col("total") * F.lit(keep)).cast("bigint")))
    reached = ranked.where(F.col("n_dates") >= 2).where(
        (F.col("cumulative") >= target) | (F.col("place") >= F.col("n_dates") - 1)
    )
    return reached.groupBy().agg(F.min("cutoff_date").alias("cutoff_date"))


def split_by_fraction(df: DataFrame, keep: float, column: str = "as_of_date") -> tuple[DataFrame, DataFrame]:
    """Left: dates up to the cutoff; right: later dates.

    The cutoff is fetched as one date, so both sides are plain filters that prune
    partitions and nested splits do not pile up subqueries.
    """
    cutoff = fraction_cutoff(df, keep, column).first()["cutoff_date"]
    if cutoff is None:
        raise ValueError("a date split needs at least two dates")
    day = F.lit(str(cutoff)).cast("date")
    return df.where(F.col(column) <= day), df.where(F.col(column) > day)


def even_sample(df: DataFrame, order: Sequence[Column], m: int, coarse: Sequence[str], fine: Sequence[str]) -> DataFrame:
    """``m`` evenly spaced rows of the ordered frame: positions ``int(i * (n-1)/(m-1))``.

    Only buckets that hold a wanted position are ranked. There are at most ``m`` of
    them, so for a usual ``m`` they are broadcast and all other rows are dropped
    before the shuffle. With ``n <= m`` every row is kept.
    """
    if m < 1:
        raise ValueError("m must be at least 1")
    offsets = bucket_offsets(df, coarse, fine)
    total, start = F.col("_total"), F.col("_offset")
    wanted = _first_wanted_at_or_after(start, total, m) < start + F.col("_size")
    buckets = offsets.where(wanted)
    ranked = global_position(df, order, coarse, fine, F.broadcast(buckets) if m <= BROADCAST_ROWS else buckets)
    position = F.col("position")
    return ranked.where(_first_wanted_at_or_after(position, total, m) == position).drop("position", "_total")


def _first_wanted_at_or_after(position: Column, total: Column, m: int) -> Column:
    """Smallest wanted position >= ``position`` (``total`` when there is none), in doubles."""
    if m == 1:
        return F.when(position <= 0, F.lit(0)).when(total <= 1, position).otherwise(total).cast("bigint")
    last = (total - 1).cast("double")
    step = F.when(total > m, last / F.lit(float(m - 1))).otherwise(F.lit(1.0))
    guess = F.floor(position.cast("double") / step)

    def at(i: Column) -> Column:
        return F.when(i >= m - 1, last).otherwise(F.floor(i.cast("double") * step))

    found = F.coalesce(*[
        F.when((i >= 0) & (at(i) >= position), at(i)) for i in (guess - 1, guess, guess + 1, guess + 2)
    ], last)
    return F.when(total <= m, position).otherwise(found.cast("bigint"))


def nested_split(df: DataFrame, sample_rows: int, order: Sequence[Column], coarse: Sequence[str],
                 fine: Sequence[str], test_start: str = TEST_START_DATE, column: str = "as_of_date") -> dict:
    """Test split, inner validation split, sample of the inner part, search split.

    The sample bounds the rows a search fits on; ``search_judged`` are all inner rows of its validation dates.
    """
    train, test = split_by_date(df, test_start, column)
    inner, validation = split_by_fraction(train, INNER_KEEP_FRACTION, column)
    sampled = even_sample(inner, order, sample_rows, coarse, fine)
    cutoff = fraction_cutoff(sampled, SEARCH_KEEP_FRACTION, column).first()["cutoff_date"]
    if cutoff is None:
        raise ValueError("a date split needs at least two dates")
    late = F.col(column) > F.lit(str(cutoff)).cast("date")
    return {"train": train, "test": test, "inner_train": inner, "inner_validation": validation, "sample": sampled,
            "search_train": sampled.where(~late), "search_validation": sampled.where(late), "search_judged": inner.where(late)}


def category_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column and distinct value, numbered 1..k in ascending order.

    Values are de-duplicated with map-side combine, then all columns are ranked together over range partitions;
    a column's numbers start at its first place, one row per column.
    """
    values = (
        df.select(*[F.col(c).try_cast("bigint").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "level")
        .where(F.col("level").isNotNull()).distinct()
    )
    placed = range_positions(values, ["column_name", "level"])
    first = placed.groupBy("column_name").agg(F.min("position").alias("_first"))
    code = (F.col("position") - F.col("_first") + 1).cast("int").alias("code")
    return placed.join(F.broadcast(first), "column_name").select("column_name", "level", code)


def encode_by_join(df: DataFrame, levels: DataFrame, column: str, target: str) -> DataFrame:
    """Number of the value among the levels of ``column``; 0 when unknown. NULL counts as 0."""
    side = levels.where(F.col("column_name") == column).select(F.col("level").alias("_level"),
                                                               F.col("code").alias("_level_code"))
    return (
        df.join(side, F.coalesce(F.col(column).cast("bigint"), F.lit(0)) == F.col("_level"), "left")
        .withColumn(target, F.coalesce(F.col("_level_code"), F.lit(0)))
        .drop("_level", "_level_code")
    )
