"""Semantic views: every metric of every table, by one dimension, against plain SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.lab import lab
from checks.registry import big, check, r
from yearring.operators.semantic import Archives, semantic_query
from yearring.plans.semantic_views import VIEWS

# archive named in a view -> derived source that stands for it
ARCHIVES = {
    "dynamic_table_refresh_history": "dynamic_table_refresh",
    "serverless_task_history": "serverless_task",
    "metering_daily_history": "metering_daily",
    "automatic_clustering_history": "auto_clustering",
    "pipe_usage_history": "pipe_usage",
    "warehouse_metering_history": "warehouse_metering",
    "storage_usage": "storage_daily",
    "database_storage_usage_history": "database_storage",
    "table_storage_metrics": "table_storage",
    "database_replication_usage_history": "replication_usage",
    "org.usage_in_currency_daily": "usage_in_currency",
    "org.remaining_balance_daily": "remaining_balance",
    "org.metering_daily_history": "metering_daily",
    "org.warehouse_metering_history": "warehouse_metering",
    "org.accounts": "accounts",
}


def archives(spark: SparkSession, sf_dir: str) -> Archives:
    """Archives with open and closed versions: the compiler must pick the current ones."""
    return lambda name: lab(spark, sf_dir).read(ARCHIVES.get(name, name), None)


def ask(spark: SparkSession, sf_dir: str, view: str, metrics: Sequence[str], dimensions=(), **rest) -> DataFrame:
    return semantic_query(VIEWS[view], archives(spark, sf_dir), metrics, dimensions, **rest)


def by_table(view: str, table: str, dimension: str, sql: str, skip: tuple[str, ...] = ()) -> None:
    names = [f"{table}.{m.name}" for m in VIEWS[view].metrics if m.table == table and m.name not in skip]
    check(f"{view}__{table}", sql)(lambda s, d: ask(s, d, view, names, [dimension]))


def n(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


TB, GB = "1099511627776.0::DOUBLE", "1073741824.0::DOUBLE"

# ---- serverless cost
by_table(
    "serverless_cost_analytics",
    "serverless_task",
    "task_name",
    f"""SELECT task_name, {r('SUM(credits_used)')} AS total_task_credits,
        COUNT(DISTINCT CAST(task_id AS VARCHAR) || CAST(start_time AS VARCHAR)) AS task_execution_count FROM serverless_task GROUP BY 1""",
)
by_table(
    "serverless_cost_analytics",
    "auto_clustering",
    "cluster_table",
    f"""SELECT table_name AS cluster_table, {r('SUM(credits_used)')} AS total_clustering_credits,
        {total('num_bytes_reclustered')} AS total_bytes_clustered FROM auto_clustering GROUP BY 1""",
)
by_table(
    "serverless_cost_analytics",
    "pipe_usage",
    "pipe_name",
    f"""SELECT pipe_name, {r('SUM(credits_used)')} AS total_pipe_credits, {total('bytes_inserted')} AS total_bytes_piped
        FROM pipe_usage GROUP BY 1""",
)
by_table(
    "serverless_cost_analytics",
    "metering_daily",
    "usage_date",
    f"""SELECT usage_date, {r('SUM(credits_used)')} AS total_daily_credits, {r('SUM(credits_billed)')} AS total_daily_billed
        FROM metering_daily GROUP BY 1""",
)
by_table(
    "serverless_cost_analytics",
    "dynamic_table_refresh",
    "dt_name",
    f"""SELECT name AS dt_name, COUNT(DISTINCT qualified_name || CAST(refresh_start_time AS VARCHAR)) AS dt_refresh_count,
        {n("state = 'SUCCEEDED'")} AS dt_success_count, {n("state IN ('FAILED', 'UPSTREAM_FAILED')")} AS dt_failure_count
        FROM dynamic_table_refresh GROUP BY 1""",
)

# ---- warehouse cost
by_table(
    "warehouse_cost_analytics",
    "warehouse_metering",
    "warehouse_name",
    f"""SELECT warehouse_name, {r('SUM(credits_used)')} AS total_credits, {r('SUM(credits_used_compute)')} AS total_compute_credits,
        {r('SUM(credits_used_cloud_services)')} AS total_cloud_credits, {r('AVG(credits_used)')} AS avg_hourly_credits
        FROM warehouse_metering GROUP BY 1""",
)
by_table(
    "warehouse_cost_analytics",
    "query_history",
    "query_user",
    f"""SELECT user_name AS query_user, COUNT(query_id) AS total_queries, {r('AVG(total_elapsed_time)')} AS avg_query_duration,
        {total('bytes_scanned')} AS total_bytes_scanned, {big('AVG(bytes_scanned)')} AS avg_bytes_scanned,
        {n("execution_status <> 'SUCCESS'")} AS failed_queries,
        {total('bytes_spilled_to_local_storage + bytes_spilled_to_remote_storage')} AS total_spill FROM query_history GROUP BY 1""",
)

# ---- security
by_table(
    "security_analytics",
    "login_history",
    "client_type",
    f"""SELECT reported_client_type AS client_type, COUNT(event_id) AS total_logins, {n("is_success = 'YES'")} AS successful_logins,
        {n("is_success = 'NO'")} AS failed_logins, COUNT(DISTINCT user_name) AS unique_users, COUNT(DISTINCT client_ip) AS unique_ips
        FROM login_history GROUP BY 1""",
)

# ---- storage
by_table(
    "storage_analytics",
    "storage_usage",
    "storage_date",
    f"""SELECT usage_date AS storage_date, {total('storage_bytes')} AS total_storage_bytes, {r(f'SUM(storage_bytes) / {TB}')} AS total_storage_tb,
        {r(f'SUM(storage_bytes) / {GB}')} AS total_storage_gb, {big('AVG(storage_bytes)')} AS avg_daily_storage FROM storage_daily GROUP BY 1""",
)
by_table(
    "storage_analytics",
    "database_storage",
    "database_name",
    f"SELECT database_name, {total('average_database_bytes')} AS total_db_storage FROM database_storage GROUP BY 1",
)
by_table(
    "storage_analytics",
    "table_storage",
    "table_catalog",
    f"SELECT table_catalog, {total('active_bytes')} AS total_table_storage FROM table_storage GROUP BY 1",
)

# ---- governance
by_table(
    "governance_analytics",
    "users",
    "default_role",
    f"""SELECT default_role, COUNT(DISTINCT user_id) AS total_users, {n("disabled = 'false'")} AS active_users,
        {n('has_mfa = TRUE')} AS mfa_users FROM users GROUP BY 1""",
)
by_table(
    "governance_analytics",
    "roles",
    "role_owner",
    "SELECT owner AS role_owner, COUNT(DISTINCT role_id) AS total_roles FROM roles GROUP BY 1",
)
by_table(
    "governance_analytics",
    "grants_to_users",
    "granted_role",
    "SELECT role AS granted_role, COUNT(DISTINCT role || grantee_name) AS total_grants FROM grants_to_users GROUP BY 1",
)

# ---- tasks
by_table(
    "task_analytics",
    "task_history",
    "task_name",
    f"""SELECT name AS task_name, COUNT(*) AS total_runs, {n("state = 'SUCCEEDED'")} AS successful_runs, {n("state = 'FAILED'")} AS failed_runs,
        {n("state = 'SKIPPED'")} AS skipped_runs FROM task_history GROUP BY 1""",
)

# ---- recovery
by_table(
    "bcdr_analytics",
    "storage_usage",
    "storage_date",
    f"""SELECT usage_date AS storage_date, {r(f'SUM(storage_bytes) / {TB}')} AS total_storage_tb, {r(f'SUM(failsafe_bytes) / {TB}')} AS total_failsafe_tb,
        {r(f'SUM(storage_bytes + failsafe_bytes + stage_bytes) / {TB}')} AS total_billed_tb FROM storage_daily GROUP BY 1""",
)
by_table(
    "bcdr_analytics",
    "database_storage",
    "database_name",
    f"""SELECT database_name, {total('average_database_bytes')} AS total_db_storage, {total('average_failsafe_bytes')} AS total_db_churn,
        {r(f'AVG(average_database_bytes) / {TB}')} AS avg_db_storage_tb, {r(f'AVG(average_failsafe_bytes) / {TB}')} AS avg_db_churn_tb
        FROM database_storage GROUP BY 1""",
)
by_table(
    "bcdr_analytics",
    "table_storage",
    "table_schema",
    f"""SELECT table_schema, COUNT(DISTINCT id) AS table_count, {n('failsafe_bytes > 0')} AS hot_table_count,
        {r(f'SUM(active_bytes) / {GB}')} AS total_table_size_gb, {r(f'SUM(time_travel_bytes) / {GB}')} AS total_time_travel_gb,
        {r(f'SUM(failsafe_bytes) / {GB}')} AS total_table_failsafe_gb FROM table_storage GROUP BY 1""",
)
by_table(
    "bcdr_analytics",
    "replication_usage",
    "replicated_database",
    f"""SELECT database_name AS replicated_database, {r('SUM(credits_used)')} AS total_replication_credits,
        {total('bytes_transferred')} AS total_bytes_replicated, COUNT(DISTINCT start_time) AS replication_count
        FROM replication_usage GROUP BY 1""",
)

# ---- cost
by_table(
    "cost_analytics",
    "metering_daily",
    "service_type",
    f"""SELECT service_type, {r('SUM(credits_used)')} AS total_daily_credits, {r('SUM(credits_used_compute)')} AS total_compute,
        {r('SUM(credits_billed)')} AS total_billed, {r('AVG(credits_used)')} AS avg_daily_credits FROM metering_daily GROUP BY 1""",
)
by_table(
    "cost_analytics",
    "warehouse_metering",
    "warehouse_name",
    f"""SELECT warehouse_name, {r('SUM(credits_used)')} AS total_warehouse_credits, {r('AVG(credits_used)')} AS avg_warehouse_credits
        FROM warehouse_metering GROUP BY 1""",
)

# ---- query performance
_SCAN = "partitions_scanned / NULLIF(partitions_total, 0)"
_SPILL = "bytes_spilled_to_local_storage + bytes_spilled_to_remote_storage"
_QUEUE = "queued_overload_time + queued_provisioning_time"
by_table(
    "query_performance_analytics",
    "query_history",
    "user_name",
    f"""SELECT user_name, COUNT(query_id) AS total_queries, {n("execution_status = 'SUCCESS'")} AS successful_queries,
        {n("execution_status <> 'SUCCESS'")} AS failed_queries, COUNT(DISTINCT query_parameterized_hash) AS unique_query_patterns,
        {r('AVG(total_elapsed_time)')} AS avg_duration_ms, MAX(total_elapsed_time) AS max_duration_ms,
        {total('total_elapsed_time')} AS total_duration_ms, quantile_disc(total_elapsed_time, 0.95) AS p95_duration_approx,
        {n('total_elapsed_time > 300000')} AS long_running_count, {total('bytes_scanned')} AS total_bytes_scanned,
        {big('AVG(bytes_scanned)')} AS avg_bytes_scanned, {total('rows_produced')} AS total_rows_produced,
        {r(f'AVG({_SCAN} * 100)')} AS avg_partition_scan_pct, {n(f'{_SCAN} > 0.9')} AS high_scan_pct_count,
        {r('AVG(percentage_scanned_from_cache)')} AS avg_cache_hit_ratio, {n('percentage_scanned_from_cache < 0.2')} AS low_cache_hit_count,
        {total(_SPILL)} AS total_spill_bytes, {n('bytes_spilled_to_remote_storage > 0')} AS queries_with_remote_spill,
        {n(f'{_SPILL} > 0')} AS queries_with_any_spill, {total(_QUEUE)} AS total_queue_time, {r(f'AVG({_QUEUE})')} AS avg_queue_time,
        {n('queued_overload_time > 30000')} AS queries_with_high_queue, {r('SUM(credits_used_cloud_services)')} AS total_cloud_credits,
        COUNT(DISTINCT user_name) AS unique_users, COUNT(DISTINCT role_name) AS unique_roles FROM query_history GROUP BY 1""",
)

# ---- organization
by_table(
    "organization_analytics",
    "usage_currency",
    "region",
    f"""SELECT a.region, {r('SUM(usage_in_currency)')} AS total_spend, {r('SUM(usage)')} AS total_credits,
        {r('AVG(usage_in_currency)')} AS avg_daily_spend FROM usage_in_currency u LEFT JOIN accounts a ON u.account_name = a.account_name GROUP BY 1""",
)
by_table(
    "organization_analytics",
    "remaining_balance",
    "contract_number",
    f"""SELECT contract_number, MAX(capacity_balance) AS latest_capacity, MAX(on_demand_consumption_balance) AS latest_on_demand
        FROM remaining_balance GROUP BY 1""",
)
by_table(
    "organization_analytics",
    "metering_daily",
    "edition",
    f"""SELECT edition, {r('SUM(credits_used)')} AS total_org_credits, {r('SUM(credits_billed)')} AS total_org_billed,
        COUNT(DISTINCT m.account_name) AS account_count FROM metering_daily m LEFT JOIN accounts a ON m.account_name = a.account_name GROUP BY 1""",
)
by_table(
    "organization_analytics",
    "warehouse_metering",
    "wh_account",
    f"""SELECT account_name AS wh_account, {r('SUM(credits_used)')} AS total_wh_credits, COUNT(DISTINCT warehouse_name) AS warehouse_count,
        {r('AVG(credits_used)')} AS avg_wh_credits FROM warehouse_metering GROUP BY 1""",
)

# ---- the compiler itself
check(
    "semantic_model",
    f"""SELECT m.service_type, {r('SUM(credits_used)')} AS total_daily_credits, {r('SUM(credits_billed)')} AS total_billed FROM metering_daily m
        WHERE usage_date >= DATE '2001-01-01' GROUP BY 1 ORDER BY total_billed DESC, service_type LIMIT 2""",
)(
    lambda s, d: ask(
        s,
        d,
        "cost_analytics",
        ["total_daily_credits", "total_billed"],
        ["service_type"],
        filters=["usage_date >= DATE '2001-01-01'"],
        order_by=[F.desc("total_billed"), "service_type"],
        limit=2,
    )
)

# Grants by two parents: the user's role and the role's owner; USERS has closed
# versions, which must not multiply the grants.
check(
    "semantic_query",
    """SELECT u.default_role, o.owner AS role_owner, COUNT(DISTINCT g.role || g.grantee_name) AS total_grants
       FROM grants_to_users g LEFT JOIN users u ON g.grantee_name = u.name LEFT JOIN roles o ON g.role = o.name
       WHERE u.disabled = 'false' GROUP BY 1, 2""",
)(
    lambda s, d: ask(
        s, d, "governance_analytics", ["total_grants"], ["default_role", "role_owner"], filters=["user_disabled = 'false'"]
    )
)

check(
    "semantic_multi_fact",
    f"""
    WITH t AS (SELECT date_trunc('month', start_time)::DATE AS month, SUM(credits_used) AS c FROM serverless_task GROUP BY 1),
        p AS (SELECT date_trunc('month', start_time)::DATE AS month, SUM(credits_used) AS c FROM pipe_usage GROUP BY 1),
        m AS (SELECT date_trunc('month', usage_date)::DATE AS month, SUM(credits_billed) AS c FROM metering_daily GROUP BY 1)
    SELECT month, {r('t.c')} AS total_task_credits, {r('p.c')} AS total_pipe_credits, {r('m.c')} AS total_daily_billed
    FROM t FULL JOIN p USING (month) FULL JOIN m USING (month)""",
)(
    lambda s, d: ask(
        s,
        d,
        "serverless_cost_analytics",
        ["total_task_credits", "total_pipe_credits", "total_daily_billed"],
        {
            "month": {
                "serverless_task": "trunc(task_start, 'month')",
                "pipe_usage": "trunc(pipe_start, 'month')",
                "metering_daily": "trunc(usage_date, 'month')",
            }
        },
    )
)

check(
    "semantic_multi_fact_total",
    f"""SELECT (SELECT {r('SUM(credits_used)')} FROM warehouse_metering) AS total_credits, (SELECT COUNT(query_id) FROM query_history) AS total_queries""",
)(lambda s, d: ask(s, d, "warehouse_cost_analytics", ["total_credits", "total_queries"]))

# Questions without a metric: tables that own none, alone and with their parent.
check(
    "semantic_dimensions",
    """SELECT DISTINCT a.user_name AS access_user, q.query_type, q.execution_status FROM access_history a
       LEFT JOIN query_history q ON a.query_id = q.query_id WHERE q.query_type IS NOT NULL""",
)(
    lambda s, d: ask(
        s, d, "query_performance_analytics", [], ["access_user", "query_type", "execution_status"], filters=["query_type IS NOT NULL"]
    )
)
check("semantic_dimensions_groups", "SELECT DISTINCT name AS group_name, type AS group_type FROM replication_groups")(
    lambda s, d: ask(s, d, "bcdr_analytics", [], ["group_name", "group_type"])
)
check(
    "semantic_security_parent",
    """SELECT u.default_role, COUNT(l.event_id) AS total_logins FROM login_history l LEFT JOIN users u ON l.user_name = u.name GROUP BY 1""",
)(lambda s, d: ask(s, d, "security_analytics", ["total_logins"], ["default_role"]))
check(
    "semantic_organization_parent",
    f"""SELECT a.edition, {r('SUM(w.credits_used)')} AS total_wh_credits FROM warehouse_metering w
        LEFT JOIN accounts a ON w.account_name = a.account_name GROUP BY 1""",
)(lambda s, d: ask(s, d, "organization_analytics", ["total_wh_credits"], ["edition"]))
