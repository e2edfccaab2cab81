from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from yearring.functions import timefn as t


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "unit,want",
    [
        ("hour", dt.datetime(2024, 3, 10, 2)),
        ("day", dt.datetime(2024, 3, 10)),
        ("month", dt.datetime(2024, 3, 1)),
        ("quarter", dt.datetime(2024, 1, 1)),
        ("year", dt.datetime(2024, 1, 1)),
    ],
)
def test_trunc_survives_the_hour_that_daylight_saving_skips(spark, unit, want):
    assert value(spark, t.trunc_ts(unit, t.ts("2024-03-10 02:30:15.5"))) == want


def test_differences_count_boundaries(spark):
    a, b = t.ts("2024-01-01 00:00:59.9"), t.ts("2024-01-01 00:01:00.1")
    assert value(spark, t.minutes_between(a, b)) == 1
    assert value(spark, t.seconds_between(a, b)) == 1
    assert value(spark, t.minutes_between(b, a)) == -1
    assert value(spark, t.days_between(t.ts("2024-01-01 23:59:59"), t.ts("2024-01-02 00:00:00"))) == 1


def test_windows_before_a_time(spark):
    assert value(spark, t.days_before("2024-03-15 10:00:00", 30)) == dt.datetime(2024, 2, 14)
    assert value(spark, t.months_before("2024-03-31 10:00:00", 1)) == dt.datetime(2024, 2, 29)


@pytest.mark.parametrize("text", ["2024-03-10 02:30:00.123456", "1969-12-31 23:59:59.999999", "2024-11-03 01:30:00"])
def test_utc_round_trip(spark, text):
    col = t.ts(text)
    assert value(spark, t.from_utc(t.to_utc(col)) == col)
    assert value(spark, F.unix_micros(t.to_utc(col))) == int(
        (dt.datetime.fromisoformat(text) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)
    )
