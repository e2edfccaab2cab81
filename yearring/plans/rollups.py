"""Rollups that dashboards read instead of the archived rows."""

from __future__ import annotations

from yearring.operators.rollup import Rollup

#: Credits per day and warehouse.
DAILY_CREDITS = Rollup(
    name="daily_credits",
    reads=("start_time", "warehouse_name", "credits_used"),
    period="CAST(CAST(start_time AS DATE) AS TIMESTAMP_NTZ)",
    dims={"warehouse_name": "warehouse_name"},
    sums={"daily_credits": "credits_used"},
)

#: Per month and warehouse, the objects that were charged and the spread of single charges.  A bitmap takes 4 kB for each 32768
#: key numbers, so its periods are such that many rows share one.
MONTHLY_CHARGES = Rollup(
    name="monthly_charges",
    reads=("start_time", "warehouse_name", "object_id", "credits_used"),
    period="make_timestamp_ntz(year(start_time), month(start_time), 1, 0, 0, 0)",
    dims={"warehouse_name": "warehouse_name"},
    distincts={"objects": "object_id"},
    quantiles={"credits": "credits_used"},
)

#: Queries per hour and warehouse, with their users and elapsed times.
HOURLY_QUERIES = Rollup(
    name="hourly_queries",
    reads=("start_time", "warehouse_name", "user_name", "role_name", "total_elapsed_time"),
    period="make_timestamp_ntz(year(start_time), month(start_time), day(start_time), hour(start_time), 0, 0)",
    dims={"warehouse_name": "warehouse_name"},
    sums={"elapsed_ms": "total_elapsed_time"},
    distincts={"users": "user_name", "roles": "role_name"},
    quantiles={"elapsed": "total_elapsed_time"},
)
