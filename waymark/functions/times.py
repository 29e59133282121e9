"""Time expressions over UTC wall-clock (``TIMESTAMP_NTZ``) columns."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down.

    Read off the wall-clock parts: ``timestampdiff`` would go through the session
    time zone and shift the hour that daylight saving skips.
    """
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def epoch_micros(ts: Column) -> Column:
    fraction = F.pmod((F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"), F.lit(1_000_000))
    return epoch_second(ts) * 1_000_000 + fraction


def as_instant(ts: Column) -> Column:
    """UTC wall clock to an instant (``TIMESTAMP``), as watermarks need it."""
    return F.timestamp_micros(epoch_micros(ts))


def utc_wall(instant: Column) -> Column:
    """An instant back to UTC wall clock, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def instants_to_utc_wall(df: DataFrame) -> DataFrame:
    """Turn every ``TIMESTAMP`` column into UTC wall clock, so that no later cast uses the session zone."""
    return df.withColumns({f.name: utc_wall(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.TimestampType)})


def duration_seconds(start: Column, end: Column) -> Column:
    return epoch_second(end) - epoch_second(start)


def weekend_flag(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7).cast("int")


def calendar_parts(ts: Column, prefix: str = "pickup") -> list[Column]:
    """Hour, day of week (1 = Sunday), month and weekend flag."""
    return [
        F.hour(ts).alias(f"{prefix}_hour"),
        F.dayofweek(ts).alias(f"{prefix}_dow"),
        F.month(ts).alias(f"{prefix}_month"),
        F.coalesce(weekend_flag(ts), F.lit(0)).alias(f"{prefix}_is_weekend"),
    ]


def event_date(*candidates: Column) -> Column:
    return F.to_date(F.coalesce(*candidates))


def cutoff(as_of: datetime, days: int) -> datetime:
    """The UTC instant ``days`` before ``as_of``."""
    if days < 0:
        raise ValueError(f"days must not be negative: {days}")
    return as_of - timedelta(days=days)
