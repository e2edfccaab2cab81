"""Cost: warehouses, credits, services, attribution."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearring.functions.measures import minutes, ratio
from yearring.functions.timefn import day, days_before, months_before, trunc_ts
from yearring.operators.temporal import current_state


def _credits() -> list:
    return [
        F.round(F.sum("credits_used"), 2).alias("total_credits"),
        F.round(F.sum("credits_used_compute"), 2).alias("compute_credits"),
        F.round(F.sum("credits_used_cloud_services"), 2).alias("cloud_credits"),
    ]


# What the report says of a warehouse that is idle, crowded or neither.
IDLE, CROWDED, FITTING = "DOWNSIZE CANDIDATE", "UPSIZE OR MULTI-CLUSTER", "APPROPRIATELY SIZED"


def warehouse_rightsizing(load: DataFrame) -> DataFrame:
    running, queued = F.col("avg_concurrent_queries"), F.col("avg_queue_depth")
    return (
        current_state(load)
        .groupBy("warehouse_name", trunc_ts("month", "start_time").alias("month"))
        .agg(
            F.avg("avg_running").alias("avg_concurrent_queries"),
            F.avg("avg_queued_load").alias("avg_queue_depth"),
            F.sum("credits_used").alias("monthly_credits"),
        )
        .withColumn(
            "recommendation",
            F.when((running < 2) & (queued < 0.1), IDLE).when(queued > 1, CROWDED).otherwise(FITTING),
        )
        .orderBy(F.desc("monthly_credits"), "warehouse_name", "month")
    )


def cost_attribution(queries: DataFrame) -> DataFrame:
    """Quarterly cost per user and role, against the user's row before.

    The window runs over the aggregate; role breaks ties inside a quarter.
    """
    before = F.lag("cloud_credits").over(Window.partitionBy("user_name").orderBy("quarter", "role_name"))
    return (
        current_state(queries)
        .groupBy("user_name", "role_name", trunc_ts("quarter", "start_time").alias("quarter"))
        .agg(
            F.count("*").alias("query_count"),
            minutes(F.sum("total_elapsed_time")).alias("total_minutes"),
            F.sum("credits_used_cloud_services").alias("cloud_credits"),
        )
        .withColumn("prev_quarter_credits", before)
        .withColumn(
            "qoq_change_pct",
            F.round(ratio(F.col("cloud_credits") - F.col("prev_quarter_credits"), "prev_quarter_credits") * 100, 2),
        )
        .orderBy(F.desc("quarter"), F.desc("cloud_credits"), "user_name", "role_name")
    )


def top_warehouses(metering: DataFrame, asof: str) -> DataFrame:
    """Credits per warehouse in the last full month."""
    month = F.trunc(day(asof), "month")
    start, end = F.add_months(month, -1).cast("timestamp_ntz"), month.cast("timestamp_ntz")
    return (
        current_state(metering)
        .filter((F.col("start_time") >= start) & (F.col("start_time") < end))
        .groupBy("warehouse_name")
        .agg(*_credits(), F.count("*").alias("metering_periods"))
        .orderBy(F.desc("total_credits"), "warehouse_name")
    )


def credits_by_month(metering: DataFrame, limit: int = 100) -> DataFrame:
    return (
        current_state(metering)
        .groupBy(trunc_ts("month", "start_time").alias("month"), "warehouse_name")
        .agg(F.sum("credits_used").alias("total_credits"))
        .orderBy(F.desc("month"), F.desc("total_credits"), "warehouse_name")
        .limit(limit)
    )


def credits_by_day(metering: DataFrame, asof: str, days: int = 30, limit: int = 50) -> DataFrame:
    return (
        current_state(metering)
        .filter(F.col("start_time") >= days_before(asof, days))
        .groupBy("warehouse_name", trunc_ts("day", "start_time").alias("usage_date"))
        .agg(*_credits())
        .orderBy(F.desc("usage_date"), F.desc("total_credits"), "warehouse_name")
        .limit(limit)
    )


def daily_credit_summary(metering: DataFrame) -> DataFrame:
    """The small day x warehouse table that dashboards read instead of the metering rows."""
    return (
        current_state(metering)
        .groupBy(trunc_ts("day", "start_time").alias("day"), "warehouse_name")
        .agg(F.sum("credits_used").alias("daily_credits"))
    )


def refresh_daily_credit_summary(metering: DataFrame, path: str) -> DataFrame:
    """Write the summary to a new folder below ``path`` and return the stored table.

    Earlier summaries stay, so what was returned for them can still be read.
    """
    summary = daily_credit_summary(metering)
    here = f"{path.rstrip('/')}/summary={uuid.uuid4().hex[:12]}"
    summary.write.parquet(here)
    return metering.sparkSession.read.schema(summary.schema).parquet(here)


def top_consumers(queries: DataFrame, asof: str, days: int = 30, limit: int = 25) -> DataFrame:
    return (
        current_state(queries)
        .filter(F.col("start_time") >= days_before(asof, days))
        .groupBy("user_name", "role_name", "warehouse_name")
        .agg(
            F.count("*").alias("query_count"),
            F.round(minutes(F.sum("total_elapsed_time")), 2).alias("total_minutes"),
            F.round(F.sum("credits_used_cloud_services"), 4).alias("cloud_credits"),
        )
        .orderBy(F.desc("cloud_credits"), "user_name", "role_name", "warehouse_name")
        .limit(limit)
    )


def refresh_costs(refreshes: DataFrame, asof: str, days: int = 7) -> DataFrame:
    """Dynamic table refreshes per table and state."""
    keys = ["name", "database_name", "schema_name", "state"]
    return (
        current_state(refreshes)
        .filter(F.col("refresh_start_time") >= days_before(asof, days))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("refresh_count"),
            F.sum(F.when(F.col("state") == "SUCCEEDED", 1).otherwise(0)).alias("successes"),
            F.sum(F.when(F.col("state").isin("FAILED", "UPSTREAM_FAILED"), 1).otherwise(0)).alias("failures"),
            F.avg("target_lag_sec").alias("avg_target_lag_sec"),
        )
        .withColumnRenamed("name", "dt_name")
        .orderBy(F.desc("refresh_count"), "dt_name", "database_name", "schema_name", "state")
    )


def serverless_tasks(tasks: DataFrame, asof: str, days: int = 30, limit: int = 20) -> DataFrame:
    return (
        current_state(tasks)
        .filter(F.col("start_time") >= days_before(asof, days))
        .groupBy("task_name", "database_name", "schema_name")
        .agg(
            F.round(F.sum("credits_used"), 4).alias("total_credits"),
            F.count("*").alias("execution_count"),
            F.round(F.avg("credits_used"), 6).alias("avg_credits_per_run"),
        )
        .orderBy(F.desc("total_credits"), "task_name", "database_name", "schema_name")
        .limit(limit)
    )


def daily_cost_by_service(metering: DataFrame, asof: str, days: int = 30) -> DataFrame:
    return (
        current_state(metering)
        .filter(F.col("usage_date") >= F.date_sub(day(asof), days))
        .groupBy("usage_date", "service_type")
        .agg(*_credits(), F.round(F.sum("credits_billed"), 2).alias("billed_credits"))
        .orderBy(F.desc("usage_date"), F.desc("total_credits"), "service_type")
    )


def contract_balance(balances: DataFrame, asof: str, days: int = 30, limit: int = 30) -> DataFrame:
    total = (
        F.col("free_usage_balance")
        + F.col("capacity_balance")
        + F.col("on_demand_consumption_balance")
        + F.col("rollover_balance")
    )
    return (
        current_state(balances)
        .filter(F.col("date") >= F.date_sub(day(asof), days))
        .groupBy("contract_number", "currency", "date")
        .agg(F.round(F.sum(total), 2).alias("total_remaining_balance"))
        .select("contract_number", "currency", "total_remaining_balance", "date")
        .orderBy(F.desc("date"), "contract_number", "currency")
        .limit(limit)
    )


def org_warehouse_credits(metering: DataFrame, asof: str, days: int = 30, limit: int = 25) -> DataFrame:
    return (
        current_state(metering)
        .filter(F.col("start_time") >= days_before(asof, days))
        .groupBy("account_name", "warehouse_name")
        .agg(*_credits())
        .orderBy(F.desc("total_credits"), "account_name", "warehouse_name")
        .limit(limit)
    )


def recent_rows(queries: DataFrame, asof: str, months: int = 1) -> DataFrame:
    """Current rows of the last month: the date filter prunes row groups."""
    return current_state(queries).filter(F.col("start_time") >= months_before(asof, months))
