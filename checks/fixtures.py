"""Usage sources derived from the test tables.

Each source is one SELECT whose expressions mean the same in Spark and DuckDB,
so the Spark side and the checking SQL start from one definition.  ``NTZ '...'``
marks a timestamp literal, spelled differently by the two engines.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

ASOF_EVENTS = "2024-01-31 00:00:00"
ASOF_ORDERS = "2001-08-02 00:00:00"
ASOF_LINES = "2001-11-05 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Source:
    base: tuple[str, ...]
    columns: str
    tail: str = ""
    strategy: str | None = None  # None: a projection of another source's archive
    watermark: str | None = None
    cut: str | None = None  # the first load takes rows below this watermark

    def sql(self) -> str:
        return f"SELECT {self.columns} FROM {self.base[0]} {self.tail}"


def _columns(text: str) -> str:
    """``name = expression`` lines to a SELECT list."""
    pairs = [line.split(" = ", 1) for line in text.strip().splitlines()]
    return ", ".join(f"{expr.strip()} AS {name.strip()}" for name, expr in pairs)


SOURCES: dict[str, Source] = {
    "query_history": Source(
        ("events",),
        _columns("""
            query_id = event_id
            start_time = ts
            end_time = ts + INTERVAL '1' SECOND * CAST(event_id % 600 AS INT)
            user_name = 'U' || CAST(user_id AS VARCHAR(20))
            role_name = 'R' || CAST(user_id % 7 AS VARCHAR(20))
            warehouse_name = 'WH' || CAST(event_id % 5 AS VARCHAR(20))
            warehouse_size = CASE event_id % 5 WHEN 0 THEN 'X-Small' WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' ELSE 'Large' END
            query_type = UPPER(event_type)
            execution_status = CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END
            error_code = CASE WHEN event_type = 'error' THEN 1000 + CAST(event_id % 9 AS INT) END
            total_elapsed_time = CAST(FLOOR(value * 3000) AS BIGINT)
            execution_time = CAST(FLOOR(value * 2500) AS BIGINT)
            compilation_time = CAST(FLOOR(value * 200) AS BIGINT)
            bytes_scanned = (event_id % 1000) * 37000001
            rows_produced = event_id % 10007
            rows_inserted = CASE WHEN event_type = 'purchase' THEN event_id % 101 ELSE 0 END
            rows_updated = event_id % 13
            rows_deleted = event_id % 3
            partitions_total = event_id % 400
            partitions_scanned = (event_id * 7) % (event_id % 400 + 1)
            bytes_spilled_to_local_storage = CASE WHEN event_id % 11 = 0 THEN (event_id % 5000) * 1000003 ELSE 0 END
            bytes_spilled_to_remote_storage = CASE WHEN event_id % 29 = 0 THEN (event_id % 700) * 1000003 ELSE 0 END
            queued_overload_time = CASE WHEN event_id % 13 = 0 THEN (event_id % 97) * 2000 ELSE 0 END
            queued_provisioning_time = (event_id % 53) * 10
            percentage_scanned_from_cache = CAST(event_id % 101 AS DOUBLE) / 103
            credits_used_cloud_services = CAST(ROUND(value * 100) AS DOUBLE) / 1024
            query_hash = 'q' || CAST(event_id % 500 AS VARCHAR(20))
            query_parameterized_hash = 'h' || CAST(event_id % 50 AS VARCHAR(20))
            database_name = CASE event_id % 4 WHEN 0 THEN 'PRODUCTION' WHEN 1 THEN 'CUSTOMER_DATA' WHEN 2 THEN 'FINANCIAL' ELSE 'DEV' END
            schema_name = 'S' || CAST(event_id % 3 AS VARCHAR(20))
            query_text = CASE WHEN event_id % 20 = 3 THEN 'select * from customer_pii' ELSE 'select ' || event_type END
            query_tag = props
        """),
        strategy="APPEND_ONLY",
        watermark="start_time",
        cut="2024-01-11 00:00:00",
    ),
    "login_history": Source(
        ("events",),
        _columns("""
            event_id = event_id
            event_timestamp = ts
            user_name = 'U' || CAST(user_id AS VARCHAR(20))
            client_ip = '10.0.0.' || CAST(user_id % 16 AS VARCHAR(20))
            reported_client_type = CASE event_id % 3 WHEN 0 THEN 'JDBC_DRIVER' WHEN 1 THEN 'PYTHON_DRIVER' ELSE 'WEB_UI' END
            is_success = CASE WHEN event_type IN ('error','signup') THEN 'NO' ELSE 'YES' END
            error_code = CASE WHEN event_type IN ('error','signup') THEN CAST(event_id % 4 AS INT) END
            error_message = CASE WHEN event_type IN ('error','signup') THEN 'E' || CAST(event_id % 4 AS VARCHAR(20)) END
            first_authentication_factor = CASE WHEN event_id % 2 = 0 THEN 'PASSWORD' ELSE 'OAUTH' END
            second_authentication_factor = CASE WHEN user_id % 3 = 0 THEN 'MFA' END
        """),
        strategy="APPEND_ONLY",
        watermark="event_timestamp",
        cut="2024-01-11 00:00:00",
    ),
    "access_log": Source(
        ("orders",),
        _columns("""
            query_id = o_orderkey
            start_time = o_orderdate
            user_name = 'U' || CAST(o_custkey % 40 AS VARCHAR(20))
            role_name = 'R' || CAST(o_custkey % 5 AS VARCHAR(20))
            query_type = o_orderstatus
            bytes_scanned = CAST(ROUND(o_totalprice * 100) AS BIGINT)
            rows_inserted = o_orderkey % 11
            rows_updated = o_orderkey % 7
            rows_deleted = o_orderkey % 3
        """),
        strategy="APPEND_ONLY",
        watermark="start_time",
        cut="2000-01-01 00:00:00",
    ),
    # Nested columns are built per engine: see access_history() below.
    "access_history": Source(
        ("lineitem",),
        "",
        strategy="APPEND_ONLY",
        watermark="query_start_time",
        cut="2000-01-01 00:00:00",
    ),
    "warehouse_metering": Source(
        ("lineitem",),
        _columns("""
            start_time = l_shipdate
            end_time = l_shipdate + INTERVAL '1' HOUR
            warehouse_id = l_suppkey
            warehouse_name = 'WH' || CAST(l_suppkey % 10 AS VARCHAR(20))
            account_name = 'A' || CAST(l_suppkey % 4 AS VARCHAR(20))
            service_type = CASE l_linenumber % 3 WHEN 0 THEN 'PIPE' WHEN 1 THEN 'WAREHOUSE_METERING' ELSE 'SERVERLESS_TASK' END
            credits_used = l_quantity
            credits_used_compute = l_quantity * (1 - l_discount)
            credits_used_cloud_services = l_quantity * l_discount
            credits_billed = l_quantity * (1 + l_tax)
            avg_running = CAST(ROUND(l_discount * 100) AS DOUBLE) / 2
            avg_queued_load = CAST(ROUND(l_tax * 100) AS DOUBLE) / 4
            object_id = l_partkey
            moved_bytes = l_partkey * 1000003
        """),
        strategy="APPEND_ONLY",
        watermark="start_time",
        cut="2000-01-01 00:00:00",
    ),
    "storage_daily": Source(
        ("orders",),
        _columns("""
            usage_date = CAST(o_orderdate AS DATE)
            database_name = o_orderpriority
            storage_bytes = CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) * 10000
            stage_bytes = CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) * 100
            failsafe_bytes = CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) * 3000
        """),
        tail="GROUP BY CAST(o_orderdate AS DATE), o_orderpriority",
        strategy="APPEND_ONLY",
        watermark="usage_date",
        cut="2000-01-01 00:00:00",
    ),
    "table_storage": Source(
        ("part",),
        _columns("""
            id = p_partkey
            table_catalog = p_brand
            table_schema = p_type
            table_name = p_name || '_' || CAST(p_partkey AS VARCHAR(20))
            active_bytes = CAST(p_size AS BIGINT) * 100000007
            time_travel_bytes = (p_partkey % 17) * 10000019
            failsafe_bytes = (p_partkey % 43) * 70000027
            retained_for_clone_bytes = (p_partkey % 5) * 1000003
            is_transient = CASE WHEN p_partkey % 10 = 0 THEN 'YES' ELSE 'NO' END
        """),
        strategy="FULL_COMPARE",
    ),
    "users": Source(
        ("customer",),
        _columns("""
            user_id = c_custkey
            name = c_name
            email = c_name || '@example.com'
            default_role = c_mktsegment
            disabled = CASE WHEN c_custkey % 8 = 0 THEN 'true' ELSE 'false' END
            has_mfa = CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 3 = 0 END
            last_success_login = NTZ '2023-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 390 AS INT)
            balance = c_acctbal
        """),
        strategy="SOFT_DELETE_MUTABLE",
    ),
    "roles": Source(
        ("nation",),
        _columns("""
            role_id = CAST(n_nationkey AS BIGINT)
            name = n_name
            owner = 'OWNER' || CAST(n_regionkey AS VARCHAR(20))
        """),
        strategy="SOFT_DELETE_MUTABLE",
    ),
    "grants_to_users": Source(
        ("customer", "nation"),
        _columns("""
            grantee_name = c_name
            role = n_name
            granted_by = 'G' || CAST(c_custkey % 6 AS VARCHAR(20))
            created_on = NTZ '2022-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 300 AS INT)
        """),
        tail="JOIN nation ON c_nationkey = n_nationkey",
        strategy="FULL_COMPARE",
    ),
    "task_history": Source(
        ("orders",),
        _columns("""
            run_id = o_orderkey
            name = 'T' || CAST(o_custkey % 40 AS VARCHAR(20))
            database_name = o_orderpriority
            schema_name = 'S' || CAST(o_custkey % 3 AS VARCHAR(20))
            state = CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'FAILED' ELSE 'SKIPPED' END
            scheduled_time = o_orderdate
            query_start_time = o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey % 60 AS INT)
            completed_time = o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey % 60 + o_custkey % 900 AS INT)
            attempt_number = CAST(1 + o_orderkey % 3 AS INT)
            error_message = CASE WHEN o_orderstatus = 'O' THEN 'E' || CAST(o_orderkey % 5 AS VARCHAR(20)) END
            moved_bytes = CAST(ROUND(o_totalprice * 100) AS BIGINT) * 1000
        """),
        strategy="APPEND_ONLY",
        watermark="scheduled_time",
        cut="2000-01-01 00:00:00",
    ),
    "accounts": Source(
        ("region",),
        _columns("""
            account_name = 'A' || CAST(r_regionkey AS VARCHAR(20))
            account_locator = 'L' || CAST(r_regionkey AS VARCHAR(20))
            region = r_name
            edition = CASE WHEN r_regionkey % 2 = 0 THEN 'ENTERPRISE' ELSE 'STANDARD' END
        """),
        strategy="SOFT_DELETE_MUTABLE",
    ),
    # Projections of the archives above.
    "serverless_task": Source(
        ("warehouse_metering",),
        _columns("""
            task_id = object_id
            start_time = start_time
            end_time = end_time
            credits_used = credits_used
            task_name = 'TK' || CAST(object_id % 30 AS VARCHAR(20))
            database_name = account_name
            schema_name = warehouse_name
        """),
        tail="WHERE service_type = 'SERVERLESS_TASK'",
    ),
    "auto_clustering": Source(
        ("warehouse_metering",),
        _columns("""
            table_id = object_id
            start_time = start_time
            credits_used = credits_used
            num_bytes_reclustered = moved_bytes
            num_rows_reclustered = object_id * 10
            table_name = 'TB' || CAST(object_id % 30 AS VARCHAR(20))
            database_name = account_name
            schema_name = warehouse_name
        """),
        tail="WHERE service_type = 'WAREHOUSE_METERING'",
    ),
    "pipe_usage": Source(
        ("warehouse_metering",),
        _columns("""
            pipe_id = object_id
            start_time = start_time
            credits_used = credits_used
            bytes_inserted = moved_bytes
            pipe_name = 'PP' || CAST(object_id % 30 AS VARCHAR(20))
        """),
        tail="WHERE service_type = 'PIPE'",
    ),
    "metering_daily": Source(
        ("warehouse_metering",),
        _columns("""
            service_type = service_type
            usage_date = CAST(start_time AS DATE)
            account_name = account_name
            region = 'R' || SUBSTRING(account_name, 2, 1)
            credits_used = credits_used
            credits_used_compute = credits_used_compute
            credits_used_cloud_services = credits_used_cloud_services
            credits_billed = credits_billed
        """),
    ),
    "usage_in_currency": Source(
        ("warehouse_metering",),
        _columns("""
            account_name = account_name
            usage_date = CAST(start_time AS DATE)
            service_level = warehouse_name
            usage_type = service_type
            usage = credits_used
            usage_in_currency = credits_used * 3
            currency = CASE WHEN warehouse_id % 2 = 0 THEN 'EUR' ELSE 'USD' END
        """),
    ),
    "dynamic_table_refresh": Source(
        ("task_history",),
        _columns("""
            qualified_name = database_name || '.' || name
            refresh_start_time = query_start_time
            refresh_end_time = completed_time
            name = name
            database_name = database_name
            schema_name = schema_name
            state = CASE state WHEN 'SKIPPED' THEN 'UPSTREAM_FAILED' ELSE state END
            target_lag_sec = run_id % 600
        """),
    ),
    "replication_usage": Source(
        ("task_history",),
        _columns("""
            database_id = run_id % 50
            database_name = database_name || CAST(run_id AS VARCHAR(20))
            start_time = query_start_time
            end_time = completed_time
            credits_used = CAST(run_id % 100 AS DOUBLE) / 8
            bytes_transferred = moved_bytes
        """),
    ),
    "database_storage": Source(
        ("storage_daily",),
        _columns("""
            usage_date = usage_date
            database_id = database_name
            database_name = database_name
            average_database_bytes = storage_bytes
            average_stage_bytes = stage_bytes
            average_failsafe_bytes = failsafe_bytes
        """),
    ),
    "remaining_balance": Source(
        ("storage_daily",),
        _columns("""
            contract_number = database_name
            date = usage_date
            currency = 'EUR'
            free_usage_balance = CAST(storage_bytes % 1000 AS DOUBLE)
            capacity_balance = CAST(stage_bytes % 100000 AS DOUBLE)
            on_demand_consumption_balance = CAST(failsafe_bytes % 7000 AS DOUBLE)
            rollover_balance = CASE WHEN storage_bytes % 30000 = 0 THEN NULL ELSE CAST(25.5 AS DOUBLE) END
        """),
    ),
    "org_storage": Source(
        ("storage_daily",),
        _columns("""
            account_name = 'A' || SUBSTRING(database_name, 1, 1)
            usage_date = usage_date
            storage_bytes = storage_bytes
            stage_bytes = stage_bytes
            failsafe_bytes = failsafe_bytes
        """),
    ),
    # A load log with many runs: every hundredth row sums up a run.
    "run_log": Source(
        ("orders",),
        _columns("""
            log_id = o_orderkey
            run_id = CAST(FLOOR(o_orderkey / 100) AS BIGINT)
            source_table = 'usage.V' || CAST(o_custkey % 50 AS VARCHAR(20))
            target_table = 'usage.V' || CAST(o_custkey % 50 AS VARCHAR(20)) || '_archive'
            rows_updated = o_orderkey % 13
            rows_inserted = o_orderkey % 101
            status = CASE WHEN o_orderkey % 100 = 0 THEN 'PARTIAL_FAILURE' WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'O' THEN 'success' ELSE 'ERROR' END
            error_message = CASE WHEN o_orderstatus = 'P' THEN 'E' || CAST(o_orderkey % 5 AS VARCHAR(20)) END
            duration_seconds = CAST(o_orderkey % 977 AS DOUBLE) / 4
            load_strategy = CASE WHEN o_orderkey % 100 = 0 THEN 'SUMMARY' WHEN o_custkey % 3 = 0 THEN 'APPEND_ONLY' ELSE 'FULL_COMPARE' END
            load_timestamp = o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey % 7200 AS INT)
        """),
    ),
    "replication_groups": Source(
        ("roles",),
        _columns("""
            replication_group_id = role_id
            name = name
            type = owner
        """),
    ),
}

LOADED = tuple(name for name, s in SOURCES.items() if s.strategy)

_ACCESS_SPARK = """
    SELECT l_orderkey AS query_id, l_shipdate AS query_start_time,
        'U' || CAST(l_suppkey % 40 AS STRING) AS user_name,
        array(named_struct('objectName', 'T' || CAST(l_partkey % 50 AS STRING),
                           'objectDomain', CASE WHEN l_linenumber % 3 = 0 THEN 'View' ELSE 'Table' END,
                           'columns', array(l_returnflag)),
              named_struct('objectName', 'B' || CAST(l_suppkey % 20 AS STRING), 'objectDomain', 'Table',
                           'columns', array(l_returnflag, l_linestatus))) AS direct_objects_accessed,
        CASE WHEN l_linestatus = 'O'
             THEN array(named_struct('objectName', 'T' || CAST(l_partkey % 50 AS STRING), 'objectDomain', 'Table',
                                     'columns', array(l_returnflag, l_linestatus)))
             ELSE array() END AS objects_modified,
        array(named_struct('policyName', 'P' || CAST(l_suppkey % 6 AS STRING), 'policyKind', l_linestatus)) AS policies_referenced
    FROM {lineitem}
"""
_ACCESS_DUCK = """
    SELECT l_orderkey AS query_id, l_shipdate AS query_start_time,
        'U' || CAST(l_suppkey % 40 AS VARCHAR) AS user_name,
        [{'objectName': 'T' || CAST(l_partkey % 50 AS VARCHAR),
          'objectDomain': CASE WHEN l_linenumber % 3 = 0 THEN 'View' ELSE 'Table' END, 'columns': [l_returnflag]},
         {'objectName': 'B' || CAST(l_suppkey % 20 AS VARCHAR), 'objectDomain': 'Table',
          'columns': [l_returnflag, l_linestatus]}] AS direct_objects_accessed,
        CASE WHEN l_linestatus = 'O'
             THEN [{'objectName': 'T' || CAST(l_partkey % 50 AS VARCHAR), 'columns': [l_returnflag, l_linestatus]}]
             ELSE [] END AS objects_modified,
        [{'policyName': 'P' || CAST(l_suppkey % 6 AS VARCHAR), 'policyKind': l_linestatus}] AS policies_referenced
    FROM lineitem
"""


# Access rows as a source delivers them: JSON text, some of it cut off, missing, or no array.
_TEXT = """CASE WHEN query_id % 97 = 0 THEN SUBSTR(to_json({c}), 1, LENGTH(to_json({c})) - 3)
                WHEN query_id % 89 = 0 THEN NULL
                WHEN query_id % 83 = 0 THEN '{{{{"objectName": "lost", "objectDomain": "Table"}}}}'
                ELSE to_json({c}) END AS {c}"""
_ACCESS_TEXT = f"""
    SELECT query_id, query_start_time, user_name, {", ".join(_TEXT.format(c=c) for c in ("direct_objects_accessed", "objects_modified"))}
    FROM {{access_history}}
"""
#: Rows whose text is an array, for the checking SQL.
WHOLE_TEXT = "query_id % 97 <> 0 AND query_id % 89 <> 0 AND query_id % 83 <> 0"


def access_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_ACCESS_TEXT, access_history=derive(spark, sf_dir, "access_history"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_sql(name: str) -> str:
    if name == "access_history":
        return _ACCESS_SPARK
    text = SOURCES[name].sql().replace("NTZ '", "TIMESTAMP_NTZ '")
    # the base names become DataFrame parameters of spark.sql
    return reduce(lambda t, b: re.sub(rf"\b(FROM|JOIN) {b}\b", rf"\1 {{{b}}}", t), SOURCES[name].base, text)


def duck_sql(name: str) -> str:
    return _ACCESS_DUCK if name == "access_history" else SOURCES[name].sql().replace("NTZ '", "TIMESTAMP '")


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source as it stands now, straight from the test tables."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    return spark.sql(spark_sql(name), **{b: derive(spark, sf_dir, b) for b in SOURCES[name].base})


def with_sources(sql: str) -> str:
    """Prefix checking SQL with the definitions of the sources it names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SOURCES:
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                visit(duck_sql(name))
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ", ".join(f"{n} AS ({duck_sql(n)})" for n in needed)
    body = sql.lstrip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
