"""Lenient text parsing that never raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.times import utc_wall

INTEGER = r"^[+-]?\d+$"
INTEGRAL = r"^[+-]?\d+(\.0*)?$"
DECIMAL = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
ZONE_SUFFIX = r"\d{1,2}:\d{1,2}.*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)$"


def safe_ts(value: Column) -> Column:
    """Text to a UTC wall-clock timestamp; blank or unreadable text becomes NULL.

    The plain cast reads both the blank- and the ``T``-separated form with or
    without fractions. Text that names an offset is shifted to UTC.
    """
    raw = F.trim(value.cast("string"))
    zoned = raw.rlike(ZONE_SUFFIX)
    return F.when(zoned, utc_wall(raw.try_cast("timestamp"))).otherwise(raw.try_cast("timestamp_ntz"))


def safe_long(value: Column) -> Column:
    raw = F.trim(value.cast("string"))
    return F.when(raw.rlike(INTEGER), raw.try_cast("bigint"))


def safe_code(value: Column) -> Column:
    """Like :func:`safe_long`, but also reads integral decimals such as ``1.0``."""
    raw = F.trim(value.cast("string"))
    return F.when(raw.rlike(INTEGRAL), F.substring_index(raw, ".", 1).try_cast("bigint"))


def safe_double(value: Column) -> Column:
    """Decimal or scientific notation only: ``NaN``, ``Infinity`` and ``1d`` become NULL."""
    raw = F.trim(value.cast("string"))
    return F.when(raw.rlike(DECIMAL), raw.try_cast("double"))


def norm_text(value: Column) -> Column:
    return F.lower(F.trim(F.coalesce(value, F.lit(""))))


def clip(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low) if not isinstance(low, Column) else low),
                   F.lit(high) if not isinstance(high, Column) else high)


def is_bad_number(value: Column) -> Column:
    """NULL or NaN, the two ways a double column can be missing."""
    return value.isNull() | F.isnan(value)


def is_infinite(value: Column) -> Column:
    return F.coalesce(F.abs(value) == F.lit(float("inf")), F.lit(False))
