"""Calendar arithmetic on TIMESTAMP_NTZ that never consults the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def ts(text: str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    return F.lit(text).cast("timestamp_ntz")


def day(text: str) -> Column:
    """The calendar day of a timestamp text, as a DATE literal."""
    return F.lit(text[:10]).cast("date")


def trunc_ts(unit: str, col: Column | str) -> Column:
    """``date_trunc`` for hour, day, month, quarter or year that stays TIMESTAMP_NTZ."""
    col = F.col(col) if isinstance(col, str) else col
    date = col.cast("date")
    if unit == "hour":
        zero = F.lit(0)
        return date.cast("timestamp_ntz") + F.make_dt_interval(zero, F.hour(col), zero, F.lit(0).cast("decimal(18,6)"))
    if unit == "day":
        return date.cast("timestamp_ntz")
    return F.trunc(date, unit).cast("timestamp_ntz")


def day_number(col: Column) -> Column:
    return F.datediff(col.cast("date"), F.lit(EPOCH).cast("date"))


def minute_number(col: Column) -> Column:
    """Whole minutes since the epoch."""
    return day_number(col).cast("bigint") * 1440 + F.hour(col) * 60 + F.minute(col)


def second_number(col: Column) -> Column:
    return minute_number(col) * 60 + F.second(col)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed, so 00:00:59 to 00:01:01 is 1."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return minute_number(end) - minute_number(start)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of second boundaries crossed."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return second_number(end) - second_number(start)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return F.datediff(end.cast("date"), start.cast("date"))


def days_before(asof: str, days: int) -> Column:
    """Midnight of the day of ``asof``, ``days`` earlier, as TIMESTAMP_NTZ."""
    return F.date_sub(day(asof), days).cast("timestamp_ntz")


def months_before(asof: str, months: int) -> Column:
    return F.add_months(day(asof), -months).cast("timestamp_ntz")


def to_utc(col: Column | str) -> Column:
    """TIMESTAMP_NTZ read as UTC, as a TIMESTAMP; event-time watermarks need that type."""
    col = F.col(col) if isinstance(col, str) else col
    micros = F.extract(F.lit("SECOND"), col) * 1_000_000
    return F.timestamp_micros(minute_number(col) * 60_000_000 + micros.cast("bigint"))


def from_utc(col: Column | str) -> Column:
    """The inverse of :func:`to_utc`."""
    col = F.col(col) if isinstance(col, str) else col
    zero = F.lit(0)
    seconds = (F.unix_micros(col).cast("decimal(38,0)") / 1_000_000).cast("decimal(18,6)")
    return ts(f"{EPOCH} 00:00:00") + F.make_dt_interval(zero, zero, zero, seconds)
