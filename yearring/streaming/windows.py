"""Window reports that keep up with the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yearring.functions.timefn import from_utc, to_utc
from yearring.plans.performance import queue_measures, queue_report


def queue_hourly(queries: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Tumbling hours of queue time per warehouse, emitted when the hour is over."""
    grouped = (
        queries.withColumn("_event_time", to_utc("start_time"))
        .withWatermark("_event_time", lateness)
        .groupBy(F.window("_event_time", "1 hour"), "warehouse_name")
        .agg(*queue_measures(F.col("queued_overload_time")))
    )
    return queue_report(grouped).withColumn("hour", from_utc("window.start")).drop("window")


def failed_logins(logins: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Failures per user in the 24 hours before each full hour."""
    return (
        logins.filter(F.col("is_success") == "NO")
        .withColumn("_event_time", to_utc("event_timestamp"))
        .withWatermark("_event_time", lateness)
        .groupBy(F.window("_event_time", "24 hours", "1 hour"), "user_name")
        .agg(F.count("*").alias("failed_attempts"))
        .select("user_name", from_utc("window.end").alias("window_end"), "failed_attempts")
    )


def append_to(report: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished windows to a Parquet folder, then stop when caught up."""
    writer = (
        report.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return writer.start()
