"""Streams over files cut from the event log, in time order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks.fixtures import derive
from checks.lab import FIRST, SECOND, fresh_store
from checks.registry import check
from checks.reports import queue_hours
from yearring.operators.scd import load_view
from yearring.session import shared_dir
from yearring.streaming import append, windows

Start = Callable[[DataFrame, str], StreamingQuery]

CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def _periods(df: DataFrame, time_column: str) -> list[DataFrame]:
    at, (one, two) = F.col(time_column), (F.lit(c).cast("timestamp_ntz") for c in CUTS)
    return [df.filter(p) for p in (at < one, (at >= one) & (at < two), at >= two)]


def _arrivals(spark: SparkSession, df: DataFrame, time_column: str, start: Start, held: Column | None = None) -> str:
    """Let a source arrive in three periods and catch up after each with the same checkpoint.

    Rows that ``held`` picks arrive with the second period.
    """
    base = f"{shared_dir(spark)}/yearring-stream-{uuid.uuid4().hex[:12]}"
    periods = _periods(df if held is None else df.filter(~held), time_column)
    if held is not None:
        periods[1] = periods[1].unionByName(df.filter(held))
    for rows in periods:
        rows.write.mode("append").parquet(f"{base}/in")
        _finish(start(append.file_stream(spark, f"{base}/in", df.schema), base))
    return base


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@check("stream_append_only", "SELECT query_id, user_name, start_time FROM query_history")
def _append_only(spark, sf_dir):
    archive = fresh_store(spark).archive("usage", "query_stream")
    _arrivals(
        spark,
        derive(spark, sf_dir, "query_history"),
        "start_time",
        lambda source, base: append.stream_append_only(source, archive, f"{base}/checkpoint", FIRST, plain=True),
    )
    return archive.read().select("query_id", "user_name", "start_time")


@check(
    "stream_append_late",
    """SELECT event_id, user_name, event_timestamp FROM login_history
       WHERE NOT (event_id % 50 = 7 AND event_timestamp < TIMESTAMP '2024-01-06')""",
)
def _append_late(spark, sf_dir):
    """Every failed login arrives twice and is stored once.

    Some logins of the first period arrive in the second: those within the lateness are stored, those beyond it are not.
    """
    logins = derive(spark, sf_dir, "login_history")
    archive = fresh_store(spark).archive("usage", "login_stream")
    at = F.col("event_timestamp")
    beyond, within = (F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz") for day in ("06", "10"))
    held = (F.col("event_id") % 50 == 7) & ((at < beyond) | ((at >= within) & (at < F.lit(CUTS[0]).cast("timestamp_ntz"))))
    _arrivals(
        spark,
        logins.unionByName(logins.filter("is_success = 'NO'")),
        "event_timestamp",
        lambda source, base: append.stream_append_late(
            source, archive, f"{base}/checkpoint", FIRST, "event_timestamp", "2 days"
        ),
        held,
    )
    return archive.read().select("event_id", "user_name", "event_timestamp")


@check("stream_append_restart", "SELECT event_id, user_name, event_timestamp FROM login_history")
def _append_restart(spark, sf_dir):
    """Every period by a new stream with a new checkpoint, started twice: all rows once."""
    logins = derive(spark, sf_dir, "login_history")
    archive = fresh_store(spark).archive("usage", "login_stream")
    for rows in _periods(logins, "event_timestamp"):
        base = f"{shared_dir(spark)}/yearring-stream-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{base}/in")
        for _ in range(2):
            _finish(append.stream_append_only(append.file_stream(spark, f"{base}/in", rows.schema), archive, f"{base}/checkpoint", FIRST, plain=True))
    return archive.read().select("event_id", "user_name", "event_timestamp")


@check(
    "stream_then_batch",
    """SELECT event_id, event_timestamp, CAST(event_timestamp < TIMESTAMP '2024-01-21' AS BOOLEAN) AS by_stream, TRUE AS _is_current FROM login_history""",
)
def _then_batch(spark, sf_dir):
    """Two periods by a stream, the rest by an append load of everything: it goes on from the stream and closes nothing."""
    logins = derive(spark, sf_dir, "login_history")
    archive = fresh_store(spark).archive("usage", "login_stream")
    base = f"{shared_dir(spark)}/yearring-stream-{uuid.uuid4().hex[:12]}"
    for rows in _periods(logins, "event_timestamp")[:2]:
        rows.write.mode("append").parquet(f"{base}/in")
        source = append.file_stream(spark, f"{base}/in", rows.schema)
        _finish(append.stream_append_only(source, archive, f"{base}/checkpoint", FIRST, "event_timestamp"))
    result = load_view(archive, logins, SECOND, "APPEND_ONLY", "event_timestamp")
    if result.status != "success":
        raise RuntimeError(result.error)
    by_stream = F.col("_loaded_at") == F.lit(FIRST).cast("timestamp_ntz")
    return archive.read().select("event_id", "event_timestamp", by_stream.alias("by_stream"), "_is_current")


@check(
    "stream_queue_hourly",
    f"""SELECT * FROM ({queue_hours('query_history')})
        WHERE hour + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', MAX(start_time)) FROM query_history) - INTERVAL 1 DAY""",
)
def _queue_hourly(spark, sf_dir):
    base = _arrivals(
        spark,
        derive(spark, sf_dir, "query_history"),
        "start_time",
        lambda source, base: windows.append_to(windows.queue_hourly(source, "1 day"), f"{base}/out", f"{base}/checkpoint"),
    )
    return spark.read.parquet(f"{base}/out")


@check(
    "stream_failed_logins",
    """WITH f AS (SELECT user_name, event_timestamp, date_trunc('hour', event_timestamp) AS h FROM login_history WHERE is_success = 'NO'),
        w AS (SELECT user_name, h + INTERVAL 1 HOUR * k AS window_end FROM f, (SELECT UNNEST(range(1, 25)) AS k))
       SELECT user_name, window_end, COUNT(*) AS failed_attempts FROM w
       WHERE window_end <= (SELECT date_trunc('millisecond', MAX(event_timestamp)) FROM f) - INTERVAL 1 DAY GROUP BY 1, 2""",
)
def _failed_logins(spark, sf_dir):
    base = _arrivals(
        spark,
        derive(spark, sf_dir, "login_history"),
        "event_timestamp",
        lambda source, base: windows.append_to(windows.failed_logins(source, "1 day"), f"{base}/out", f"{base}/checkpoint"),
    )
    return spark.read.parquet(f"{base}/out")
