"""Dates, times of day and distances in time between rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

MICROS = 1_000_000
WINDOW_SECONDS = 7200

# Day names, 0 = Sunday.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(as_of: datetime | str) -> Column:
    """The explicit "now" of a report, as a zone-less timestamp."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def measured_since(df: DataFrame, since: Column, after: bool = False, before: Column | None = None) -> DataFrame:
    """Rows measured at or after ``since`` (``after``: strictly later), and earlier than ``before`` where it is given.

    A table partitioned by ``measurement_date`` is bounded on that column too, so
    that whole partitions are skipped.
    """
    t = F.col("measurement_time")
    out = df.filter(t > since if after else t >= since)
    if before is not None:
        out = out.filter(t < before)
    if "measurement_date" in df.columns:
        out = out.filter(F.col("measurement_date") >= F.to_date(since))
        if before is not None:
            out = out.filter(F.col("measurement_date") <= F.to_date(before))
    return out


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col(ts))


def start_ts(date: Column | str = "event_start_date", sec: Column | str = "start_sec") -> Column:
    return F.timestamp_add("SECOND", col(sec), col(date).cast("timestamp_ntz"))


def start_micros(date: Column | str = "event_start_date", sec: Column | str = "start_sec") -> Column:
    """Same instant as :func:`start_ts` in microseconds; plain arithmetic on the day number."""
    days = F.unix_date(col(date)).cast("bigint")
    return (days * 86400 + col(sec).cast("bigint")) * MICROS


def day_of_week(ts: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col(ts)) - 1


def day_name(dow: Column | str) -> Column:
    return F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), col(dow))


def start_of_hour(ts: Column | str) -> Column:
    """The zone-less hour a timestamp falls into; date_trunc would go through the session zone."""
    return F.timestamp_add("HOUR", F.hour(col(ts)), F.to_date(col(ts)).cast("timestamp_ntz"))


def hour_of(sec: Column | str) -> Column:
    return F.floor(col(sec) / 3600).cast("int")


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end``; negative when ``end`` is earlier."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3600.0 * MICROS)


def whole_days_between(start: Column, end: Column) -> Column:
    """Day part of ``end - start``, truncated toward zero like an interval's day field."""
    days = F.timestamp_diff("SECOND", start, end) / F.lit(86400.0)
    return F.when(days >= 0, F.floor(days)).otherwise(F.ceil(days))


def time_bin(us: Column, seconds: int = WINDOW_SECONDS) -> Column:
    return F.floor(us / F.lit(seconds * MICROS)).cast("bigint")
