"""Reports where the plan takes another road than the plain SQL, against brute force."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from yearring.plans import performance, security, storage, tasks

BASE = dt.datetime(2024, 3, 9, 12)


def test_failed_logins_24h_against_brute_force(spark):
    rng = random.Random(7)
    day = dt.timedelta(days=1)
    times = [BASE + dt.timedelta(seconds=rng.randrange(0, 200_000), microseconds=rng.choice([0, 0, 1])) for _ in range(120)]
    times += [t + day for t in times[:20]] + [t + day + dt.timedelta(microseconds=1) for t in times[:20]] + times[:10] + [None, None]
    data = [(i, t, rng.choice(["a", "b", "", None]), "NO" if i % 5 else "YES") for i, t in enumerate(times)]
    df = spark.createDataFrame(
        [(i, t.isoformat(sep=" ") if t else None, u, s) for i, t, u, s in data], "event_id int, t string, user_name string, is_success string"
    )
    names = ["client_ip", "reported_client_type", "error_code", "error_message", "first_authentication_factor", "second_authentication_factor"]
    logins = df.select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("event_timestamp"), "user_name", "is_success", F.lit(True).alias("_is_current"), *[F.lit("x").alias(n) for n in names]
    )
    got = {r["event_id"]: r["failed_attempts_24h"] for r in security.failed_logins_24h(logins).collect()}
    failed = [(i, t, u) for i, t, u, s in data if s == "NO"]
    for i, t, u in failed:
        same = [x for _, x, v in failed if v == u]
        want = sum(x is None for x in same) if t is None else sum(x is not None and t - day <= x <= t for x in same)
        assert got[i] == want, (i, t, u)
    assert len(got) == len(failed)


def test_access_counts_mentions_in_one_query(spark):
    queries = spark.sql("SELECT 1 AS query_id, TIMESTAMP_NTZ '2024-01-02' AS start_time, 'u' AS user_name, 'r' AS role_name, 10 * 1073741824L AS bytes_scanned, true AS _is_current")
    access = spark.sql(
        """SELECT 1 AS query_id, true AS _is_current, array(named_struct('objectName', 't', 'objectDomain', 'Table'),
           named_struct('objectName', 't', 'objectDomain', 'Table'), named_struct('objectName', 'v', 'objectDomain', 'View')) AS direct_objects_accessed
           UNION ALL SELECT 2, true, array() UNION ALL SELECT 1, false, array(named_struct('objectName', 't', 'objectDomain', 'Table'))"""
    )
    (row,) = performance.user_table_access(queries, access, "2024-01-03 00:00:00").collect()
    assert (row["access_count"], row["total_gb_scanned"]) == (2, 20.0)


def test_growth_counts_rows_not_days(spark):
    df = spark.sql(
        """SELECT DATE'2024-01-01' + CAST(id * 2 AS INT) AS usage_date, (id + 1) * 1099511627776 AS average_database_bytes,
           0L AS average_stage_bytes, 0L AS average_failsafe_bytes, true AS _is_current FROM range(40)"""
    )
    got = {r["usage_date"]: r["monthly_growth_pct"] for r in storage.storage_growth(df).collect()}
    assert got[dt.date(2024, 1, 1)] is None
    assert got[dt.date(2024, 1, 1) + dt.timedelta(days=60)] == 3000.0


def test_latest_run_breaks_ties_by_run_id(spark):
    df = spark.sql(
        """SELECT 'a' AS name, TIMESTAMP_NTZ '2024-01-01' AS scheduled_time, id AS run_id, 'S' AS state,
           CAST(NULL AS TIMESTAMP_NTZ) AS completed_time, CAST(NULL AS STRING) AS error_message FROM range(3)"""
    )
    assert [r["run_id"] for r in tasks.latest_task_run(df).collect()] == [2]
    untimed = df.withColumns({"name": F.lit("b"), "scheduled_time": F.lit(None).cast("timestamp_ntz")})
    some = untimed.unionByName(df.withColumn("name", F.lit("b")).filter("run_id = 0"))
    assert [(r["name"], r["run_id"]) for r in tasks.latest_task_run(untimed).collect()] == [("b", 2)]
    assert [(r["name"], r["run_id"]) for r in tasks.latest_task_run(some).collect()] == [("b", 0)]
