from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from yearring.operators import control, monitor
from yearring.operators.control import RegistryEntry
from yearring.operators.pipeline import result_rows, run_load
from yearring.operators.scd import APPEND_ONLY

REGISTRY = [
    RegistryEntry("s", "good"),
    RegistryEntry("s", "log", True, APPEND_ONLY, "t"),
    RegistryEntry("s", "breaks"),
    RegistryEntry("s", "absent"),
    RegistryEntry("s", "off", False),
]


def reader(spark, n):
    def read(schema, view):
        if view == "absent":
            return None
        if view == "breaks":
            return spark.range(3).select(F.raise_error(F.lit("boom")).cast("int").alias("x"))
        if view == "log":
            return spark.sql(f"SELECT id, TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(CAST(id AS INT)) AS t FROM range({n})")
        return spark.range(n)

    return read


def test_a_failed_source_does_not_stop_the_run(spark, store):
    one = run_load(store, REGISTRY, reader(spark, 3), "2024-02-01 00:00:00")
    assert (one.run_id, one.success_count, one.skipped_count, one.error_count) == (1, 2, 1, 1)
    assert (one.total_inserted, one.total_updated, one.status) == (6, 0, "PARTIAL_FAILURE")
    two = run_load(store, REGISTRY, reader(spark, 5), "2024-02-02 00:00:00", parallel=1)
    assert (two.run_id, two.total_inserted) == (2, 4)
    log = control.load_log(store)
    assert log.count() == 10 and log.select("log_id").distinct().count() == 10
    assert [r["status"] for r in log.filter("load_strategy = 'SUMMARY'").collect()] == ["PARTIAL_FAILURE"] * 2
    assert [r["source_table"] for r in monitor.run_failures_latest(log).collect()] == ["s.absent", "s.breaks"]
    assert "boom" in log.filter("status = 'ERROR'").first()["error_message"]
    assert result_rows(two, spark).filter("status = 'success'").count() == 2
    assert monitor.last_load(log).first()["status"] == "PARTIAL_FAILURE"
    summary = monitor.load_summary_by_run(log).first()
    assert (summary["views_processed"], summary["successes"], summary["failures"]) == (4, 2, 2)
    state = control.watermark_state(store).collect()
    assert [(r["source_view"], str(r["last_watermark_value"])) for r in state] == [("log", "2024-01-05 00:00:00")]


def test_runs_never_share_a_number(spark, store):
    """A run that has not written its log yet still keeps its number."""
    assert [control.reserve_run(store, 0) for _ in range(3)] == [1, 2, 3]
    assert control.reserve_run(store, 1) == 4


def test_strategy_comes_from_the_active_entry():
    assert control.strategy_for(REGISTRY, "s", "log") == (APPEND_ONLY, "t")
    assert control.strategy_for(REGISTRY, "s", "off") == ("FULL_COMPARE", None)


def test_samples_have_the_rows_asked_for(spark):
    df = spark.range(12_000).withColumn("_is_current", F.col("id") % 8 != 0)
    assert [monitor.sample_archive(df, n).count() for n in (1, 5, 10_400, 20_000)] == [1, 5, 10_400, 10_500]
    for n in (0, -1):
        with pytest.raises(ValueError):
            monitor.sample_archive(df, n)

