"""One run over the registry: load every active source, write the log."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.operators.control import LOG_SCHEMA, RegistryEntry, load_log, log_archive, reserve_run, strategy_for
from yearring.operators.scd import LoadResult, load_view
from yearring.operators.schedule import RunControl
from yearring.sources.store import ArchiveStore

Reader = Callable[[str, str], DataFrame | None]


@dataclass(frozen=True)
class RunSummary:
    run_id: int
    start_time: str
    duration_seconds: float
    views_in_registry: int
    views_processed: int
    success_count: int
    skipped_count: int
    error_count: int
    total_inserted: int
    total_updated: int
    table_results: tuple[LoadResult, ...]

    @property
    def status(self) -> str:
        return "SUCCESS" if self.error_count == 0 else "PARTIAL_FAILURE"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def run_load(
    store: ArchiveStore,
    registry: Iterable[RegistryEntry],
    read: Reader,
    now: str | None = None,
    system: str = "SOURCE",
    parallel: int = 4,
    plain: Collection[str] = (),
    control: RunControl | None = None,
) -> RunSummary:
    """Load the active sources in (schema, view) order of the log.

    The loads are independent Spark jobs, so a few run at a time and fill each
    other's idle tasks, each in a scheduler pool of its own.  A source that fails, or that ``control`` cancels, is logged and the run goes on;
    ``read`` returns None for a source that does not exist.  ``plain`` names the views whose source is a plain scan of files.
    Archives get Bloom filters on the registered key column.
    """
    spark = store.spark
    active = sorted((e for e in registry if e.is_active), key=lambda e: (e.source_schema, e.source_view))
    now = now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    control = control or RunControl(spark)
    run_id = reserve_run(store, load_log(store).agg(F.max("run_id").alias("m")).first()["m"] or 0)

    def one(entry: RegistryEntry) -> tuple[LoadResult, float]:
        began = time.monotonic()
        archive = store.archive(entry.source_schema, entry.source_view)
        try:
            with control.source(entry.source_schema, entry.source_view):
                source = read(entry.source_schema, entry.source_view)
                strategy, column = strategy_for(active, entry.source_schema, entry.source_view)
                result = load_view(
                    archive, source, now, strategy, column, system, plain=entry.source_view in plain, key=entry.unique_key_column
                )
        except Exception as error:
            name = f"{entry.source_schema}.{entry.source_view}"
            result = LoadResult(name, f"{name}_archive", "error", strategy=entry.load_strategy, error=str(error), timestamp=now)
        if result.status == "error" and (stopped := control.reason(entry.source_schema, entry.source_view)):
            result = replace(result, error=stopped)
        return result, time.monotonic() - began

    began = time.monotonic()
    with control.watching(), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        loaded = list(pool.map(one, active))
    took = time.monotonic() - began

    results = tuple(r for r, _ in loaded)
    done = [r for r in results if r.status == "success"]
    summary = RunSummary(
        run_id=run_id,
        start_time=now,
        duration_seconds=round(took, 2),
        views_in_registry=len(active),
        views_processed=len(results),
        success_count=len(done),
        skipped_count=sum(r.status == "skipped" for r in results),
        error_count=sum(r.status == "error" for r in results),
        total_inserted=sum(r.rows_inserted for r in done),
        total_updated=sum(r.rows_updated for r in done),
        table_results=results,
    )
    _write_log(store, summary, active, [s for _, s in loaded], now)
    return summary


def _write_log(store: ArchiveStore, run: RunSummary, active: list[RegistryEntry], seconds: list[float], now: str) -> None:
    rows = [
        (
            run.run_id,
            r.source,
            r.target,
            r.rows_updated,
            r.rows_inserted,
            r.status.upper(),
            r.error or r.reason,
            f"{s:.2f}",
            e.load_strategy,
            now,
            _sha(json.dumps(asdict(r), sort_keys=True)),
        )
        for r, e, s in zip(run.table_results, active, seconds)
    ]
    fingerprint = _sha(f"SUMMARY|{run.views_processed}|{run.total_updated}|{run.total_inserted}")
    rows.append(
        (run.run_id, "ALL_VIEWS", "ALL_ARCHIVES", run.total_updated, run.total_inserted, run.status, None, f"{run.duration_seconds:.2f}", "SUMMARY", now, fingerprint)
    )
    text = LOG_SCHEMA.replace("decimal(10,2)", "string").replace("timestamp_ntz", "string")
    log = store.spark.createDataFrame(rows, text).coalesce(1)
    log = log.withColumns(
        {
            "duration_seconds": F.col("duration_seconds").cast("decimal(10,2)"),
            "load_timestamp": F.col("load_timestamp").cast("timestamp_ntz"),
        }
    )
    log_archive(store).append_plain(log, now)


def result_rows(summary: RunSummary, spark) -> DataFrame:
    """The per-source results of a run as a DataFrame."""
    schema = (
        "source string, target string, status string, action string, strategy string, "
        "rows_inserted bigint, rows_updated bigint, reason string, error string, timestamp string"
    )
    return spark.createDataFrame([tuple(asdict(r).values()) for r in summary.table_results], schema)
