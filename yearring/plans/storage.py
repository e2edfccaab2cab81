"""Storage volume, growth and churn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearring.functions.measures import gb, percent, ratio, tb
from yearring.functions.timefn import day
from yearring.operators.temporal import current_state


def storage_growth(usage: DataFrame, back: int = 30) -> DataFrame:
    """Daily totals in TB with the change against ``back`` rows before.

    Rows are first brought to one per day, so the ordered window holds at most
    one row per calendar day whatever the input size.
    """
    parts = ["stage_bytes", "database_bytes", "failsafe_bytes"]
    daily = current_state(usage).groupBy("usage_date").agg(*[F.sum(f"average_{p}").alias(p) for p in parts])
    trend = daily.select(
        "usage_date",
        tb("stage_bytes").alias("stage_tb"),
        tb("database_bytes").alias("database_tb"),
        tb("failsafe_bytes").alias("failsafe_tb"),
        tb(F.col("stage_bytes") + F.col("database_bytes") + F.col("failsafe_bytes")).alias("total_tb"),
    )
    before = F.lag("total_tb", back).over(Window.orderBy("usage_date"))
    return (
        trend.withColumn("_before", before)
        .withColumn("monthly_growth_pct", ratio(F.col("total_tb") - F.col("_before"), "_before") * 100)
        .drop("_before")
        .orderBy(F.desc("usage_date"))
    )


def storage_inventory(usage: DataFrame) -> DataFrame:
    total = F.col("average_database_bytes") + F.col("average_stage_bytes") + F.col("average_failsafe_bytes")
    return (
        current_state(usage)
        .groupBy(F.trunc("usage_date", "month").alias("month"))
        .agg(
            tb(F.sum("average_database_bytes")).alias("database_tb"),
            tb(F.sum("average_stage_bytes")).alias("stage_tb"),
            tb(F.sum("average_failsafe_bytes")).alias("failsafe_tb"),
            tb(F.sum(total)).alias("total_tb"),
        )
        .orderBy(F.desc("month"))
    )


def _filled(tables: DataFrame, order: str, limit: int) -> DataFrame:
    return (
        current_state(tables)
        .filter(F.col("active_bytes") > 0)
        .orderBy(F.desc_nulls_last(order), "id")
        .limit(limit)
    )


def _churn(high: str) -> F.Column:
    lost, held = F.col("failsafe_bytes"), F.col("active_bytes")
    return F.when(lost > held * 0.5, high).when(lost > held * 0.1, "MEDIUM CHURN").otherwise("LOW CHURN")


def _names() -> list:
    return [F.col("table_catalog").alias("database_name"), F.col("table_schema").alias("schema_name"), "table_name"]


def hot_tables(tables: DataFrame, limit: int = 50) -> DataFrame:
    return _filled(tables, "failsafe_bytes", limit).select(
        *_names(),
        gb("active_bytes").alias("active_gb"),
        gb("time_travel_bytes").alias("time_travel_gb"),
        gb("failsafe_bytes").alias("failsafe_gb"),
        F.round(percent("failsafe_bytes", "active_bytes"), 2).alias("churn_pct"),
        _churn("HIGH CHURN").alias("churn_category"),
    )


def hot_tables_dr(tables: DataFrame, limit: int = 30) -> DataFrame:
    return _filled(tables, "failsafe_bytes", limit).select(
        *_names(),
        F.round(gb("active_bytes"), 2).alias("active_gb"),
        F.round(gb("failsafe_bytes"), 2).alias("failsafe_gb"),
        F.round(percent("failsafe_bytes", "active_bytes"), 2).alias("churn_pct"),
        _churn("HIGH CHURN - Priority DR").alias("dr_priority"),
    )


def largest_tables(tables: DataFrame, limit: int = 25) -> DataFrame:
    total = F.col("active_bytes") + F.col("time_travel_bytes") + F.col("failsafe_bytes")
    return _filled(tables, "active_bytes", limit).select(
        *_names(),
        F.round(gb("active_bytes"), 2).alias("active_gb"),
        F.round(gb("time_travel_bytes"), 2).alias("time_travel_gb"),
        F.round(gb("failsafe_bytes"), 2).alias("failsafe_gb"),
        F.round(gb(total), 2).alias("total_gb"),
    )


def storage_by_database(usage: DataFrame, asof: str, days: int = 90) -> DataFrame:
    return (
        current_state(usage)
        .filter(F.col("usage_date") >= F.date_sub(day(asof), days))
        .select(
            "database_name",
            "usage_date",
            F.round(gb("average_database_bytes"), 2).alias("database_gb"),
            F.round(gb("average_failsafe_bytes"), 2).alias("failsafe_gb"),
        )
        .orderBy("database_name", F.desc("usage_date"))
    )


def org_storage(usage: DataFrame, asof: str, days: int = 30) -> DataFrame:
    return (
        current_state(usage)
        .filter(F.col("usage_date") >= F.date_sub(day(asof), days))
        .groupBy("account_name")
        .agg(
            F.round(tb(F.avg("storage_bytes")), 2).alias("avg_storage_tb"),
            F.round(tb(F.avg("stage_bytes")), 2).alias("avg_stage_tb"),
            F.round(tb(F.avg("failsafe_bytes")), 2).alias("avg_failsafe_tb"),
        )
        .orderBy(F.desc("avg_storage_tb"), "account_name")
    )
