"""Reports on the pipeline itself: log, watermarks, registry, inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.functions.measures import count_if
from yearring.functions.timefn import trunc_ts, ts
from yearring.sources.store import ArchiveStore

def _newest_first(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc_nulls_last("load_timestamp"), F.desc("log_id"))


def load_history(log: DataFrame, limit: int = 100) -> DataFrame:
    columns = ["log_id", "load_timestamp", "source_table", "target_table", "rows_updated", "rows_inserted", "status", "duration_seconds", "error_message"]
    return _newest_first(log).limit(limit).select(*columns)


def last_load(log: DataFrame) -> DataFrame:
    columns = ["rows_updated", "rows_inserted", "status", "duration_seconds"]
    return _newest_first(log).limit(1).select(F.col("load_timestamp").alias("last_load_time"), *columns)


def load_log_recent(log: DataFrame, limit: int = 50) -> DataFrame:
    columns = ["source_table", "target_table", "load_strategy", "status", "rows_inserted", "rows_updated", "duration_seconds", "load_timestamp"]
    return _newest_first(log).limit(limit).select(*columns)


def _details(log: DataFrame) -> DataFrame:
    return log.filter(F.col("load_strategy") != "SUMMARY")


def load_summary_by_run(log: DataFrame, limit: int = 20) -> DataFrame:
    """Totals per hour and run.  Summary rows are left out: they would count everything twice."""
    won = F.upper("status") == "SUCCESS"
    seconds = F.col("duration_seconds").cast("double")
    return (
        _details(log)
        .groupBy(trunc_ts("hour", "load_timestamp").alias("run_hour"), "run_id")
        .agg(
            F.count("*").alias("views_processed"),
            count_if(won).alias("successes"),
            count_if(~won).alias("failures"),
            F.sum("rows_inserted").alias("total_inserted"),
            F.sum("rows_updated").alias("total_updated"),
            F.round(F.sum(seconds), 0).alias("total_duration_sec"),
            F.round(F.avg(seconds), 2).alias("avg_duration_sec"),
        )
        .orderBy(F.desc("run_hour"), F.desc("run_id"))
        .limit(limit)
    )


def failed_loads(log: DataFrame, asof: str, days: int = 7) -> DataFrame:
    since = ts(asof) - F.make_dt_interval(F.lit(days))
    columns = ["source_table", "target_table", "load_strategy", "status", "error_message", "load_timestamp", "duration_seconds"]
    failed = _details(log).filter((F.upper("status") != "SUCCESS") & (F.col("load_timestamp") >= since))
    return _newest_first(failed).select(*columns)


def run_failures_latest(log: DataFrame) -> DataFrame:
    """Details of the newest run that did not succeed."""
    latest = log.agg(F.max("run_id").alias("run_id"))
    failed = _details(log).filter(F.upper("status") != "SUCCESS")
    return failed.join(F.broadcast(latest), "run_id", "left_semi").orderBy("source_table")


def watermark_status(state: DataFrame, registry: DataFrame) -> DataFrame:
    columns = ["source_schema", "source_view", "last_watermark_value", "last_watermark", "watermark_type", "last_loaded_at", "load_strategy", "watermark_column", "is_active"]
    joined = state.join(registry, ["source_schema", "source_view"])
    return joined.select(*columns).orderBy(F.desc("last_loaded_at"), "source_schema", "source_view")


def registry_health(registry: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Sources per strategy and flag, named in order; with ``counts`` also their rows."""
    name = "source_schema || '.' || source_view"
    measures = [
        F.count("*").alias("view_count"),
        F.expr(f"listagg({name}, ', ') WITHIN GROUP (ORDER BY {name})").alias("views"),
    ]
    if counts is not None:
        registry = registry.join(counts, ["source_schema", "source_view"], "left")
        measures.append(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
    return registry.groupBy("load_strategy", "is_active").agg(*measures).orderBy(F.desc("is_active"), "load_strategy")


def inactive_views(registry: DataFrame) -> DataFrame:
    columns = ["source_schema", "source_view", "load_strategy", "watermark_column", "is_active"]
    return registry.filter(~F.col("is_active")).select(*columns).orderBy("source_schema", "source_view")


def archive_inventory(store: ArchiveStore) -> DataFrame:
    return store.inventory().filter(F.col("table_name").like("%\\_archive")).orderBy("source_schema", "table_name")


def archive_summary(inventory: DataFrame) -> DataFrame:
    return (
        inventory.groupBy("source_schema")
        .agg(
            F.count("*").alias("table_count"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
            F.max("last_modified").alias("last_update"),
        )
        .orderBy("source_schema")
    )


def view_discovery_summary(views: DataFrame, tables: DataFrame) -> DataFrame:
    """Per schema: sources, those with an archive, those still waiting."""
    v, t = views.alias("v"), tables.alias("t")
    same = (F.col("t.schema_name") == F.col("v.schema_name")) & (
        F.col("t.table_name") == F.concat("v.view_name", F.lit("_archive"))
    )
    return (
        v.join(t, same, "left")
        .groupBy("v.schema_name")
        .agg(F.count("v.view_name").alias("total_views"), F.count("t.table_name").alias("archived_views"))
        .withColumn("pending_views", F.col("total_views") - F.col("archived_views"))
        .orderBy("schema_name")
    )


def row_count_union(archives: dict[str, DataFrame]) -> DataFrame:
    """One counting branch per archive, all in one query."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in archives.items()]
    return reduce(DataFrame.unionByName, counts)


def sample_archive(archive: DataFrame, limit: int = 100) -> DataFrame:
    """Some current rows, as many as asked for."""
    if limit < 1:
        raise ValueError(f"limit must be 1 or more, not {limit}")
    return archive.filter("_is_current").limit(limit)


def export_csv(report: DataFrame, path: str) -> str:
    """Write a report as CSV with a header, in as many files as it has partitions."""
    report.write.mode("overwrite").option("header", True).csv(path)
    return path
