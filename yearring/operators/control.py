"""Registry, watermark state and log: the small tables that steer a run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearring.operators.scd import FULL_COMPARE
from yearring.sources.store import Archive, ArchiveStore

REGISTRY_SCHEMA = (
    "source_schema string, source_view string, is_active boolean, load_strategy string, "
    "watermark_column string, unique_key_column string, created_at timestamp_ntz"
)
LOG_SCHEMA = (
    "run_id bigint, source_table string, target_table string, rows_updated bigint, rows_inserted bigint, "
    "status string, error_message string, duration_seconds decimal(10,2), load_strategy string, "
    "load_timestamp timestamp_ntz, _row_hash string"
)


@dataclass(frozen=True)
class RegistryEntry:
    source_schema: str
    source_view: str
    is_active: bool = True
    load_strategy: str = FULL_COMPARE
    watermark_column: str | None = None
    unique_key_column: str | None = None


def registry_table(spark: SparkSession, entries: Iterable[RegistryEntry], now: str) -> DataFrame:
    rows = [(e.source_schema, e.source_view, e.is_active, e.load_strategy, e.watermark_column, e.unique_key_column) for e in entries]
    plain = REGISTRY_SCHEMA.rsplit(", ", 1)[0]
    return spark.createDataFrame(rows, plain).withColumn("created_at", F.lit(now).cast("timestamp_ntz"))


def strategy_for(entries: Iterable[RegistryEntry], schema: str, view: str) -> tuple[str, str | None]:
    """Strategy and watermark column of the active entry; full compare without one."""
    for e in entries:
        if (e.source_schema, e.source_view) == (schema, view) and e.is_active:
            return e.load_strategy or FULL_COMPARE, e.watermark_column
    return FULL_COMPARE, None


def watermark_get(archive: Archive) -> str | None:
    manifest = archive.manifest()
    return manifest.watermark if manifest else None


def watermark_state(store: ArchiveStore) -> DataFrame:
    """Watermark per source, as committed with the data it covers.

    ``last_watermark`` is its text and ``watermark_type`` the column's type; ``last_watermark_value`` is the time, if it is one.
    Instants are stored as microseconds since 1970 and shown in UTC.
    """
    rows = []
    for archive in store.archives():
        m = archive.manifest()
        if m.watermark is not None:
            rows.append((archive.schema, archive.view, m.watermark, m.watermark_type, m.modified, m.rows_loaded))
    raw = store.spark.createDataFrame(
        rows,
        "source_schema string, source_view string, last_watermark string, watermark_type string, last_loaded_at string, rows_loaded bigint",
    )
    text, kind = F.col("last_watermark"), F.col("watermark_type")
    instant = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(text.try_cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))
    value = F.when(kind.isin("date", "timestamp_ntz"), text.try_cast("timestamp_ntz")).when(kind == "timestamp", instant)
    return raw.withColumns({"last_watermark_value": value, "last_loaded_at": F.col("last_loaded_at").cast("timestamp_ntz")})


def log_archive(store: ArchiveStore) -> Archive:
    return store.archive("control", "load_log")


def reserve_run(store: ArchiveStore, last: int) -> int:
    """A run number above ``last`` that no other run has, even one that has not written its log yet."""
    number = last + 1
    while True:
        try:
            store.fs.write_new(f"{log_archive(store).path}/_runs/{number:08d}", "")
            return number
        except RuntimeError:
            number += 1


def load_log(store: ArchiveStore) -> DataFrame:
    archive = log_archive(store)
    if archive.manifest() is None:
        return store.spark.createDataFrame([], "log_id bigint, " + LOG_SCHEMA)
    return archive.read()
