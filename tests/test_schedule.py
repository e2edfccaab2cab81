from __future__ import annotations

import threading
import time

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from yearring.operators import control
from yearring.operators.control import RegistryEntry
from yearring.operators.pipeline import run_load
from yearring.operators.schedule import RunControl

REGISTRY = [RegistryEntry("s", name) for name in ("a", "b", "slow")] + [RegistryEntry("s", "keyed", unique_key_column="id")]


@F.udf(LongType())
def sleepy(x):
    time.sleep(60)
    return x


def reader(spark, seen=None):
    def read(schema, view):
        if seen is not None:
            seen[view] = (spark.sparkContext.getLocalProperty("spark.scheduler.pool"), set(spark.sparkContext.getJobTags()))
        rows = spark.range(5)
        return rows.select(sleepy("id").alias("id")) if view == "slow" else rows

    return read


def statuses(run):
    return {r.source: r.status for r in run.table_results}


def test_one_source_is_cancelled_and_the_others_finish(spark, store):
    stop = RunControl(spark)
    threading.Timer(3, stop.cancel, ("s", "slow")).start()
    began = time.monotonic()
    run = run_load(store, REGISTRY, reader(spark), "2024-02-01 00:00:00", control=stop)
    assert time.monotonic() - began < 50
    assert statuses(run) == {"s.a": "success", "s.b": "success", "s.keyed": "success", "s.slow": "error"}
    assert control.load_log(store).filter("status = 'ERROR'").first()["error_message"] == "cancelled: on request"
    slow = store.archive("s", "slow")
    assert slow.manifest() is None and slow.fs.names(f"{slow.path}/staging") == []
    assert store.archive("s", "keyed").manifest().key == "id"


def test_a_source_over_the_limit_is_cancelled(spark, store):
    run = run_load(store, REGISTRY[:3], reader(spark), "2024-02-01 00:00:00", parallel=3, control=RunControl(spark, time_limit=15))
    assert statuses(run) == {"s.a": "success", "s.b": "success", "s.slow": "error"}
    assert run.table_results[2].error == "cancelled: took more than 15 seconds"


def test_a_cancelled_source_does_not_begin(spark, store):
    stop, seen = RunControl(spark), {}
    stop.cancel("s", "slow")
    run = run_load(store, REGISTRY, reader(spark, seen), "2024-02-01 00:00:00", control=stop)
    assert statuses(run)["s.slow"] == "error" and "slow" not in seen
    # Each source has its pool and tag; nothing of that stays in a thread.
    assert {v: p for v, (p, _) in seen.items()} == {v: f"s.{v}" for v in ("a", "b", "keyed")}
    assert all(tags == {stop.tag("s", v)} for v, (_, tags) in seen.items())
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and not spark.sparkContext.getJobTags()
