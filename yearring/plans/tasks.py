"""Task runs and replication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.functions.measures import count_if, gb
from yearring.functions.timefn import days_before, minutes_between, seconds_between, ts
from yearring.operators.temporal import current_state


def task_failures(tasks: DataFrame, asof: str, days: int = 7) -> DataFrame:
    keys = ["task_name", "database_name", "schema_name", "state"]
    failed = F.col("state") == "FAILED"
    return (
        current_state(tasks)
        .filter(F.col("scheduled_time") >= days_before(asof, days))
        .groupBy(F.col("name").alias("task_name"), *keys[1:])
        .agg(
            F.count("*").alias("run_count"),
            count_if(failed).alias("failure_count"),
            F.max("error_message").alias("latest_error"),
        )
        .filter("failure_count > 0")
        .withColumn("failure_pct", F.round(F.col("failure_count") * 100.0 / F.col("run_count"), 2))
        .orderBy(F.desc("failure_count"), *keys)
    )


def task_timeline(tasks: DataFrame, asof: str, hours: int = 24) -> DataFrame:
    since = ts(asof) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (
        current_state(tasks)
        .filter(F.col("scheduled_time") >= since)
        .orderBy(F.desc("scheduled_time"), "run_id")
        .select(
            F.col("name").alias("task_name"),
            "state",
            "scheduled_time",
            "query_start_time",
            "completed_time",
            seconds_between("query_start_time", "completed_time").alias("duration_seconds"),
            "attempt_number",
            "error_message",
        )
    )


def task_history_recent(tasks: DataFrame, asof: str, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        tasks.filter(F.col("scheduled_time") >= days_before(asof, days))
        .orderBy(F.desc("scheduled_time"), "run_id")
        .limit(limit)
        .select("name", "state", "scheduled_time", "completed_time", "error_message")
    )


def latest_task_run(tasks: DataFrame) -> DataFrame:
    """Newest run per task name.

    The maximum of a struct keeps one row per name and map task; a ranking
    window would sort all runs of a busy task in one place.  Runs without a time come before all others,
    so a name that has no other keeps one of them.
    """
    columns = ["scheduled_time", "run_id", "state", "completed_time", "error_message"]
    return (
        tasks.groupBy("name")
        .agg(F.max(F.struct(*columns)).alias("run"))
        .select("name", *[F.col(f"run.{c}").alias(c) for c in columns])
    )


def replication_rpo(replication: DataFrame, asof: str, days: int = 7) -> DataFrame:
    return (
        current_state(replication)
        .filter(F.col("start_time") >= days_before(asof, days))
        .select(
            "database_name",
            "start_time",
            "end_time",
            minutes_between("start_time", "end_time").alias("replication_minutes"),
            F.round("credits_used", 4).alias("credits"),
            F.round(gb("bytes_transferred"), 2).alias("gb_transferred"),
        )
        .orderBy(F.desc("start_time"), "database_name")
    )
