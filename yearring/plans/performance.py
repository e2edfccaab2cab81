"""Query performance, spills, queues, scans, nested access records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearring.functions.documents import flattened
from yearring.functions.measures import GB, count_if, gb, minutes, percent, ratio, seconds, tb
from yearring.functions.timefn import days_before, months_before, trunc_ts
from yearring.operators.temporal import current_state

# Query ids are a few bytes each: a million stay well inside a broadcast.
BROADCAST_QUERIES = 1_000_000
# Limits and labels of the reports.
_LONG_MS, _QUEUE_MS = 300_000, 30_000
UNUSUAL_HIGH = "ANOMALY: Significantly higher than historical average"
UNUSUAL_LOW = "ANOMALY: Significantly lower than historical average"
USUAL = "NORMAL"
SPILL_GRADES = ("CRITICAL: Upsize warehouse", "WARNING: Consider upsizing", "OK")
QUEUE_GRADES = ("CRITICAL: Multi-cluster or upsize", "WARNING: Consider scaling", "OK")
LONG_ALERT, SCAN_ALERT, QUEUE_ALERT, CACHE_ALERT = "LONG_RUNNING", "HIGH_SCAN_PCT", "HIGH_QUEUE", "CACHE_MISS"
REMOTE_ALERT, LOCAL_ALERT = "REMOTE_SPILL", "LOCAL_SPILL"


def _recent(queries: DataFrame, asof: str, days: int) -> DataFrame:
    return current_state(queries).filter(F.col("start_time") >= days_before(asof, days))


def _scans_most() -> F.Column:
    return ratio("partitions_scanned", "partitions_total") > 0.9


def query_anomalies(queries: DataFrame, asof: str, unit: str = "month", back: int = 12, months: int = 6) -> DataFrame:
    """Query counts per user and period against the periods before (3 sigma)."""
    frame = Window.partitionBy("user_name").orderBy(unit).rowsBetween(-back, -1)
    n, mean, sigma = F.col("query_count"), F.col("avg_query_count_12mo"), F.col("stddev_query_count_12mo")
    return (
        current_state(queries)
        .groupBy("user_name", trunc_ts(unit, "start_time").alias(unit))
        .agg(F.count("*").alias("query_count"), F.sum("bytes_scanned").alias("total_bytes"))
        .withColumns(
            {
                "avg_query_count_12mo": F.avg("query_count").over(frame),
                "stddev_query_count_12mo": F.stddev("query_count").over(frame),
            }
        )
        .withColumn(
            "anomaly_flag",
            F.when(n > mean + 3 * sigma, UNUSUAL_HIGH)
            .when(n < mean - 3 * sigma, UNUSUAL_LOW)
            .otherwise(USUAL),
        )
        .filter(F.col(unit) >= months_before(asof, months))
        .orderBy(F.desc(unit), "user_name")
    )


def long_running(queries: DataFrame, limit: int = 50) -> DataFrame:
    return (
        current_state(queries)
        .filter(F.col("total_elapsed_time") > _LONG_MS)
        .orderBy(F.desc("total_elapsed_time"), "query_id")
        .limit(limit)
        .select(
            "query_id",
            "user_name",
            "role_name",
            "warehouse_name",
            "warehouse_size",
            "query_type",
            minutes("total_elapsed_time").alias("duration_minutes"),
            gb("bytes_scanned").alias("gb_scanned"),
            "partitions_scanned",
            "partitions_total",
            F.round(percent("partitions_scanned", "partitions_total"), 2).alias("partition_scan_pct"),
            "execution_status",
            "start_time",
        )
    )


def long_running_recent(queries: DataFrame, asof: str, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        _recent(queries, asof, days)
        .filter(F.col("total_elapsed_time") > _LONG_MS)
        .orderBy(F.desc("total_elapsed_time"), "query_id")
        .limit(limit)
        .select(
            "query_id",
            "user_name",
            "warehouse_name",
            "warehouse_size",
            "query_type",
            F.round(minutes("total_elapsed_time"), 2).alias("duration_minutes"),
            F.round(gb("bytes_scanned"), 2).alias("gb_scanned"),
            "execution_status",
            "start_time",
        )
    )


def high_partition_scan(queries: DataFrame, asof: str, days: int = 30, limit: int = 20) -> DataFrame:
    """Query shapes that read most partitions, with the schemas they touch."""
    place = F.concat("database_name", F.lit("."), "schema_name")
    return (
        _recent(queries, asof, days)
        .filter((F.col("partitions_total") > 100) & _scans_most())
        .groupBy("query_parameterized_hash")
        .agg(
            F.count("*").alias("execution_count"),
            seconds(F.avg("total_elapsed_time")).alias("avg_duration_sec"),
            F.avg(percent("partitions_scanned", "partitions_total")).alias("avg_scan_pct"),
            F.max("partitions_total").alias("max_partitions"),
            tb(F.sum("bytes_scanned")).alias("total_tb_scanned"),
            F.array_join(F.sort_array(F.collect_set(place)), ", ").alias("databases_accessed"),
        )
        .orderBy(F.desc("total_tb_scanned"), "query_parameterized_hash")
        .limit(limit)
    )


def high_partition_scan_by_user(
    queries: DataFrame, asof: str, days: int = 7, least: int = 3, limit: int = 20
) -> DataFrame:
    keys = ["user_name", "warehouse_name", "query_parameterized_hash"]
    return (
        _recent(queries, asof, days)
        .filter((F.col("partitions_total") > 100) & _scans_most())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("execution_count"),
            F.avg(ratio("partitions_scanned", "partitions_total") * 100).alias("avg_scan_pct"),
            F.avg(seconds("total_elapsed_time")).alias("avg_duration_seconds"),
            gb(F.sum("bytes_scanned")).alias("total_gb_scanned"),
        )
        .filter(F.col("execution_count") >= least)
        .orderBy(F.desc("total_gb_scanned"), *keys)
        .limit(limit)
    )


def spill_queries(queries: DataFrame, limit: int = 50) -> DataFrame:
    local, remote = F.col("bytes_spilled_to_local_storage"), F.col("bytes_spilled_to_remote_storage")
    return (
        current_state(queries)
        .filter((local > 0) | (remote > 0))
        .orderBy(remote.desc(), local.desc(), "query_id")
        .limit(limit)
        .select(
            "user_name",
            "warehouse_name",
            "warehouse_size",
            "query_type",
            "query_id",
            seconds("total_elapsed_time").alias("duration_sec"),
            gb(local).alias("local_spill_gb"),
            gb(remote).alias("remote_spill_gb"),
            gb("bytes_scanned").alias("gb_scanned"),
            F.when(remote > 0, SPILL_GRADES[0])
            .when(local > GB, SPILL_GRADES[1])
            .otherwise(SPILL_GRADES[2])
            .alias("recommendation"),
            "start_time",
        )
    )


def spill_by_user(queries: DataFrame, asof: str, days: int = 30, limit: int = 10) -> DataFrame:
    keys = ["user_name", "warehouse_name", "warehouse_size"]
    return (
        _recent(queries, asof, days)
        .filter(F.col("bytes_spilled_to_remote_storage") > 0)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("spill_count"),
            F.round(gb(F.sum("bytes_spilled_to_remote_storage")), 2).alias("total_remote_spill_gb"),
            F.round(seconds(F.avg("total_elapsed_time")), 2).alias("avg_duration_seconds"),
        )
        .orderBy(F.desc("total_remote_spill_gb"), *keys)
        .limit(limit)
    )


def remote_spill_recent(queries: DataFrame, asof: str, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        _recent(queries, asof, days)
        .filter(F.col("bytes_spilled_to_remote_storage") > 0)
        .orderBy(F.desc("bytes_spilled_to_remote_storage"), "query_id")
        .limit(limit)
        .select(
            "user_name",
            "warehouse_name",
            "warehouse_size",
            "query_id",
            F.round(seconds("total_elapsed_time"), 2).alias("duration_sec"),
            F.round(gb("bytes_spilled_to_remote_storage"), 2).alias("remote_spill_gb"),
            F.round(gb("bytes_spilled_to_local_storage"), 2).alias("local_spill_gb"),
            "start_time",
        )
    )


def queue_time_hourly(queries: DataFrame, asof: str, days: int = 7) -> DataFrame:
    queued = F.col("queued_overload_time")
    return queue_report(
        _recent(queries, asof, days)
        .groupBy("warehouse_name", trunc_ts("hour", "start_time").alias("hour"))
        .agg(*queue_measures(queued))
    ).orderBy(F.desc("avg_queue_sec"), "warehouse_name", "hour")


def queue_measures(queued: F.Column) -> list:
    return [
        F.count("*").alias("query_count"),
        F.avg(queued).alias("_avg_ms"),
        F.max(queued).alias("_max_ms"),
        count_if(queued > _QUEUE_MS).alias("high_queue_count"),
    ]


def queue_report(grouped: DataFrame) -> DataFrame:
    """Keep the groups with a mean wait above 5 s and grade them."""
    mean = F.col("_avg_ms")
    return (
        grouped.filter(mean > 5000)
        .withColumns(
            {
                "avg_queue_sec": seconds(mean),
                "max_queue_sec": seconds("_max_ms"),
                "pct_queued": F.round(F.col("high_queue_count") * 100.0 / F.col("query_count"), 2),
                "recommendation": F.when(mean > 60_000, QUEUE_GRADES[0]).when(mean > _QUEUE_MS, QUEUE_GRADES[1]).otherwise(QUEUE_GRADES[2]),
            }
        )
        .drop("_avg_ms", "_max_ms")
    )


def _accessed(queries: DataFrame, access: DataFrame, array: str, *fields: str) -> DataFrame:
    """One row per (query, object) with its number of mentions, for the access rows of ``queries``.

    Access rows of other queries go before anything is exploded: by a broadcast of the queries' ids while their counted number is at
    most a million, beyond that by a hash join, so that the wide access rows are never sorted.  Counting before the join keeps the shuffle small and collapses
    a query that holds a large share of the access rows.  The objects are an array of structs or, as the source delivers
    them, JSON text; text that is no array of objects names none.
    """
    ids = queries.select("query_id")
    # Neither way sorts the access rows, and only the second one moves them.
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_QUERIES else ids.distinct().hint("shuffle_hash")
    mine = current_state(access).select("query_id", array).join(ids, "query_id", "left_semi")
    if dict(access.dtypes)[array] == "string":
        paths = {f: (f"$.{f}", "string") for f in fields}
        items = flattened(mine, array, paths, ["query_id"], as_text=tuple(f for f in fields if f == "columns"))
    else:
        columns = [F.col(f"item.{f}").alias(f) for f in fields]
        items = mine.select("query_id", F.explode(array).alias("item")).select("query_id", *columns)
    return items.groupBy("query_id", *fields).agg(F.count("*").alias("mentions"))


def user_table_access(queries: DataFrame, access: DataFrame, asof: str, days: int = 30, limit: int = 100) -> DataFrame:
    recent = _recent(queries, asof, days)
    objects = _accessed(recent, access, "direct_objects_accessed", "objectName", "objectDomain").filter(
        F.col("objectDomain") == "Table"
    )
    keys = ["user_name", "role_name", "table_accessed", "object_type"]
    return (
        recent.join(objects, "query_id")
        .groupBy("user_name", "role_name", F.col("objectName").alias("table_accessed"), F.col("objectDomain").alias("object_type"))
        .agg(
            F.sum("mentions").alias("access_count"),
            F.min("start_time").alias("first_access"),
            F.max("start_time").alias("last_access"),
            gb(F.sum(F.col("bytes_scanned") * F.col("mentions"))).alias("total_gb_scanned"),
        )
        .orderBy(F.desc("access_count"), *keys)
        .limit(limit)
    )


def user_table_access_repeated(
    access: DataFrame, asof: str, days: int = 7, least: int = 5, limit: int = 20
) -> DataFrame:
    return (
        current_state(access)
        .filter(F.col("query_start_time") >= days_before(asof, days))
        .select("user_name", "query_start_time", F.explode("direct_objects_accessed").alias("item"))
        .groupBy(
            "user_name",
            F.col("item.objectName").alias("table_accessed"),
            F.col("item.objectDomain").alias("object_type"),
        )
        .agg(
            F.count("*").alias("access_count"),
            F.min("query_start_time").alias("first_access"),
            F.max("query_start_time").alias("last_access"),
        )
        .filter(F.col("access_count") >= least)
        .orderBy(F.desc("access_count"), "user_name", "table_accessed", "object_type")
        .limit(limit)
    )


def lineage_modified(queries: DataFrame, access: DataFrame, asof: str, days: int = 30) -> DataFrame:
    """Who changed which objects; the column list is part of the key."""
    recent = _recent(queries, asof, days)
    objects = _accessed(recent, access, "objects_modified", "objectName", "columns")
    columns = F.col("columns") if dict(objects.dtypes)["columns"] == "string" else F.to_json("columns")
    weight = F.col("mentions")
    return (
        recent.join(objects, "query_id")
        .groupBy(
            "user_name",
            "role_name",
            "query_type",
            F.col("objectName").alias("table_modified"),
            columns.alias("columns_modified"),
        )
        .agg(
            F.sum(weight).alias("modification_count"),
            F.sum(F.col("rows_inserted") * weight).alias("total_rows_inserted"),
            F.sum(F.col("rows_updated") * weight).alias("total_rows_updated"),
            F.sum(F.col("rows_deleted") * weight).alias("total_rows_deleted"),
            F.min("start_time").alias("first_modification"),
            F.max("start_time").alias("last_modification"),
        )
        .orderBy(F.desc("modification_count"), "user_name", "role_name", "query_type", "table_modified", "columns_modified")
    )


def policy_access(queries: DataFrame, access: DataFrame, asof: str, days: int = 90) -> DataFrame:
    recent = _recent(queries, asof, days)
    policies = _accessed(recent, access, "policies_referenced", "policyName", "policyKind")
    keys = ["user_name", "role_name", "query_type", "policy_name", "policy_type"]
    return (
        recent.join(policies, "query_id")
        .groupBy(*keys[:3], F.col("policyName").alias("policy_name"), F.col("policyKind").alias("policy_type"))
        .agg(
            F.sum("mentions").alias("access_count"),
            F.min("start_time").alias("first_access"),
            F.max("start_time").alias("last_access"),
        )
        .orderBy(F.desc("access_count"), *keys)
    )


def cache_efficiency(queries: DataFrame, asof: str, days: int = 7) -> DataFrame:
    hit = F.col("percentage_scanned_from_cache")
    return (
        _recent(queries, asof, days)
        .filter(F.col("bytes_scanned") > 0)
        .groupBy("warehouse_name", F.hour("start_time").alias("hour_of_day"))
        .agg(
            F.count("*").alias("query_count"),
            (F.avg(hit) * 100).alias("avg_cache_hit_pct"),
            count_if(hit < 0.2).alias("low_cache_queries"),
            tb(F.sum("bytes_scanned")).alias("total_tb_scanned"),
            tb(F.sum(F.col("bytes_scanned") * (1 - hit))).alias("tb_from_storage"),
        )
        .orderBy("warehouse_name", "hour_of_day")
    )


def repeated_patterns(queries: DataFrame, asof: str, days: int = 30, least: int = 10, limit: int = 20) -> DataFrame:
    return (
        _recent(queries, asof, days)
        .filter(F.col("execution_status") == "SUCCESS")
        .groupBy("query_parameterized_hash")
        .agg(
            F.count("*").alias("execution_count"),
            F.countDistinct("user_name").alias("unique_users"),
            seconds(F.avg("total_elapsed_time")).alias("avg_duration_sec"),
            minutes(F.sum("total_elapsed_time")).alias("total_duration_min"),
            gb(F.avg("bytes_scanned")).alias("avg_gb_scanned"),
            tb(F.sum("bytes_scanned")).alias("total_tb_scanned"),
            F.sum("credits_used_cloud_services").alias("total_cloud_credits"),
            F.avg(percent("partitions_scanned", "partitions_total")).alias("avg_partition_scan_pct"),
            F.max("query_text").alias("sample_query"),
        )
        .filter(F.col("execution_count") >= least)
        .orderBy(F.desc("total_tb_scanned"), "query_parameterized_hash")
        .limit(limit)
    )


def alert_dashboard(queries: DataFrame, asof: str, days: int = 1) -> DataFrame:
    local, remote = F.col("bytes_spilled_to_local_storage"), F.col("bytes_spilled_to_remote_storage")
    slow = F.col("total_elapsed_time") > _LONG_MS
    waiting = F.col("queued_overload_time") > _QUEUE_MS
    cold = (F.col("percentage_scanned_from_cache") < 0.1) & (F.col("bytes_scanned") > GB)
    return (
        _recent(queries, asof, days)
        .filter(slow | _scans_most() | (remote > 0) | waiting)
        .select(
            "query_id",
            "user_name",
            "warehouse_name",
            "start_time",
            minutes("total_elapsed_time").alias("duration_min"),
            F.when(slow, LONG_ALERT).alias("long_running_alert"),
            F.when(_scans_most(), SCAN_ALERT).alias("partition_alert"),
            F.when(remote > 0, REMOTE_ALERT).when(local > GB, LOCAL_ALERT).alias("spill_alert"),
            F.when(waiting, QUEUE_ALERT).alias("queue_alert"),
            F.when(cold, CACHE_ALERT).alias("cache_alert"),
        )
        .orderBy(F.desc("start_time"), "query_id")
    )


def top_query_users(queries: DataFrame, limit: int = 20) -> DataFrame:
    return (
        current_state(queries)
        .groupBy("user_name")
        .agg(F.count("*").alias("query_count"), minutes(F.sum("total_elapsed_time")).alias("total_minutes"))
        .orderBy(F.desc("query_count"), "user_name")
        .limit(limit)
    )


def query_type_distribution(queries: DataFrame, limit: int = 20) -> DataFrame:
    return (
        current_state(queries)
        .groupBy("query_type")
        .agg(F.count("*").alias("query_count"), seconds(F.avg("total_elapsed_time")).alias("avg_seconds"))
        .orderBy(F.desc("query_count"), "query_type")
        .limit(limit)
    )
