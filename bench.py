"""Times the loads, the history queries, the reports and the semantic views.

Prints one JSON line.  BENCH_SF_DIR names the data folder, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import functions as F

from checks import QUERIES
from checks.fixtures import SOURCES, derive
from checks.lab import FIRST, SECOND, THIRD, fresh_store, lab
from yearring.operators import scd, temporal
from yearring.session import local_session

def loads(spark, sf_dir: str, timed: Callable) -> None:
    """Load strategies on the largest source (one row per line item)."""
    store = fresh_store(spark)
    metering = derive(spark, sf_dir, "warehouse_metering")
    cut = F.lit("2001-07-01").cast("timestamp_ntz")
    log = store.archive("bench", "metering_log")
    timed("scd2_initial", lambda: scd.load_initial(log, metering.filter(F.col("start_time") < cut), FIRST, watermark_column="start_time", plain=True))
    timed("scd2_append_only", lambda: scd.load_append_only(log, metering, SECOND, "start_time", plain=True))
    full = store.archive("bench", "metering_full")
    scd.load_initial(full, metering, FIRST, plain=True)
    timed("scd2_full_unchanged", lambda: scd.load_full(full, metering, SECOND, plain=True))

    def changed(share: int):
        part = F.pmod(F.xxhash64("start_time", "warehouse_id", "object_id"), F.lit(100)) < share
        return metering.withColumn("credits_billed", F.when(part, F.col("credits_billed") + 1).otherwise(F.col("credits_billed")))

    timed("scd2_full_1pct", lambda: scd.load_full(full, changed(1), THIRD, plain=True))
    timed("scd2_full_10pct", lambda: scd.load_full(full, changed(10), "2024-02-04 06:00:00", plain=True))
    timed("as_of_full", lambda: noop(temporal.as_of(full.read(), THIRD)))
    timed("current_state_full", lambda: noop(temporal.current_state(full.read("open"))))
    timed("verify_hash_full", lambda: noop(temporal.verify_hash(full.read())))


def warm_up(spark, sf_dir: str) -> None:
    """Two loads of a small source, so that the first timed load does not pay for class loading."""
    archive = fresh_store(spark).archive("bench", "warm_up")
    users = derive(spark, sf_dir, "users")
    scd.load_initial(archive, users, FIRST, plain=True)
    scd.load_full(archive, users.filter("user_id % 10 <> 3"), SECOND, plain=True)
    noop(archive.read().groupBy("default_role").count())


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": str(cpus)})
    seconds: dict[str, float] = {}

    def timed(name: str, run: Callable) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    warm_up(spark, sf_dir)
    loads(spark, sf_dir, timed)
    here = lab(spark, sf_dir)
    for name in [n for n in SOURCES if SOURCES[n].strategy]:
        timed(f"load_{name}", lambda name=name: here.archive(name))
    timed("load_user_snapshots", here.snapshots)
    # Two runs over the whole registry; the queries on its results are timed on their own below.
    timed("run_registry_twice", here.pipeline)
    for name, query in QUERIES.items():
        timed(name if name not in seconds else f"{name}_query", lambda query=query: noop(query(spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": cpus,
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
