"""Small numeric expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GB = float(1024**3)
TB = float(1024**4)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def gb(col: Column | str) -> Column:
    return _c(col) / F.lit(GB)


def tb(col: Column | str) -> Column:
    return _c(col) / F.lit(TB)


def minutes(ms: Column | str) -> Column:
    # One division: two would leave 17.385 just below the half and round it down.
    return _c(ms) / 60_000


def seconds(ms: Column | str) -> Column:
    return _c(ms) / 1000


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL where den is 0 or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def percent(num: Column | str, den: Column | str) -> Column:
    return _c(num) * F.lit(100.0) / F.nullif(_c(den).cast("double"), F.lit(0.0))


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL over no rows, unlike COUNT."""
    return F.sum(F.when(cond, 1).otherwise(0))
