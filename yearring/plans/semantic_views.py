"""The ten semantic views.

The names of views, tables, facts, dimensions and metrics, the columns behind
them and the metric definitions are fixed values: questions written against
them must keep working.  Facts and dimensions map each name to its column.
"""

from __future__ import annotations

from yearring.operators.semantic import Metric, Relationship, SemanticView, Table


def _table(
    name: str,
    archive: str,
    key: tuple[str, ...],
    facts: dict[str, str] | None = None,
    dimensions: dict[str, str] | None = None,
    synonyms: tuple[str, ...] = (),
) -> Table:
    return Table(name, archive, key, facts or {}, dimensions or {}, synonyms)


def _metrics(table: str, **definitions: str) -> tuple[Metric, ...]:
    return tuple(Metric(name, table, text) for name, text in definitions.items())


def _count_if(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


def _tb(total: str) -> str:
    return f"{total} / power(1024, 4)"


def _gb(total: str) -> str:
    return f"{total} / power(1024, 3)"


SERVERLESS_COST = SemanticView(
    "serverless_cost_analytics",
    "Cost of compute without a warehouse: refreshes, tasks, pipes, clustering",
    (
        _table(
            "dynamic_table_refresh",
            "dynamic_table_refresh_history",
            ("qualified_name", "refresh_start_time"),
            dimensions={
                "dt_name": "name",
                "dt_database": "database_name",
                "dt_schema": "schema_name",
                "dt_qualified_name": "qualified_name",
                "dt_state": "state",
                "dt_refresh_action": "refresh_action",
                "dt_refresh_trigger": "refresh_trigger",
                "dt_refresh_start": "refresh_start_time",
                "dt_refresh_end": "refresh_end_time",
                "dt_target_lag": "target_lag_sec",
                "dt_query_id": "query_id",
            },
            synonyms=("dynamic tables", "refresh runs"),
        ),
        _table(
            "serverless_task",
            "serverless_task_history",
            ("task_id", "start_time"),
            {"task_credits": "credits_used"},
            {
                "task_name": "task_name",
                "task_database": "database_name",
                "task_schema": "schema_name",
                "task_start": "start_time",
                "task_end": "end_time",
            },
            ("serverless tasks", "task credits"),
        ),
        _table(
            "metering_daily",
            "metering_daily_history",
            ("service_type", "usage_date"),
            {
                "daily_credits": "credits_used",
                "daily_compute_credits": "credits_used_compute",
                "daily_cloud_credits": "credits_used_cloud_services",
                "daily_billed": "credits_billed",
            },
            {"service_type": "service_type", "usage_date": "usage_date"},
            ("daily metering", "service costs"),
        ),
        _table(
            "auto_clustering",
            "automatic_clustering_history",
            ("table_id", "start_time"),
            {
                "clustering_credits": "credits_used",
                "bytes_reclustered": "num_bytes_reclustered",
                "rows_reclustered": "num_rows_reclustered",
            },
            {
                "cluster_table": "table_name",
                "cluster_database": "database_name",
                "cluster_schema": "schema_name",
                "cluster_start": "start_time",
            },
            ("clustering", "reclustering"),
        ),
        _table(
            "pipe_usage",
            "pipe_usage_history",
            ("pipe_id", "start_time"),
            {"pipe_credits": "credits_used", "bytes_ingested": "bytes_inserted"},
            {"pipe_name": "pipe_name", "pipe_start": "start_time"},
            ("pipes", "ingestion"),
        ),
    ),
    (
        *_metrics(
            "serverless_task",
            total_task_credits="sum(task_credits)",
            task_execution_count="count(DISTINCT task_id || start_time)",
        ),
        *_metrics(
            "auto_clustering",
            total_clustering_credits="sum(clustering_credits)",
            total_bytes_clustered="sum(bytes_reclustered)",
        ),
        *_metrics("pipe_usage", total_pipe_credits="sum(pipe_credits)", total_bytes_piped="sum(bytes_ingested)"),
        *_metrics("metering_daily", total_daily_credits="sum(daily_credits)", total_daily_billed="sum(daily_billed)"),
        *_metrics(
            "dynamic_table_refresh",
            dt_refresh_count="count(DISTINCT qualified_name || refresh_start_time)",
            dt_success_count=_count_if("dt_state = 'SUCCEEDED'"),
            dt_failure_count=_count_if("dt_state IN ('FAILED', 'UPSTREAM_FAILED')"),
        ),
    ),
)

WAREHOUSE_COST = SemanticView(
    "warehouse_cost_analytics",
    "Warehouse credits and the queries that spend them",
    (
        _table(
            "warehouse_metering",
            "warehouse_metering_history",
            ("start_time", "warehouse_id"),
            {
                "credits_used": "credits_used",
                "credits_compute": "credits_used_compute",
                "credits_cloud": "credits_used_cloud_services",
            },
            {"warehouse_name": "warehouse_name", "metering_start": "start_time", "metering_end": "end_time"},
            ("metering", "warehouse credits"),
        ),
        _table(
            "query_history",
            "query_history",
            ("query_id",),
            {
                "query_duration": "total_elapsed_time",
                "bytes_scanned": "bytes_scanned",
                "rows_produced": "rows_produced",
                "partitions_scanned": "partitions_scanned",
                "partitions_total": "partitions_total",
                "bytes_spilled_local": "bytes_spilled_to_local_storage",
                "bytes_spilled_remote": "bytes_spilled_to_remote_storage",
                "compilation_time": "compilation_time",
                "execution_time": "execution_time",
                "queued_time": "queued_provisioning_time",
            },
            {
                "query_id": "query_id",
                "query_user": "user_name",
                "query_role": "role_name",
                "query_type": "query_type",
                "query_database": "database_name",
                "query_schema": "schema_name",
                "query_warehouse": "warehouse_name",
                "warehouse_size": "warehouse_size",
                "warehouse_type": "warehouse_type",
                "execution_status": "execution_status",
                "error_code": "error_code",
                "query_start": "start_time",
                "query_end": "end_time",
                "query_tag": "query_tag",
            },
            ("queries", "statements"),
        ),
    ),
    (
        *_metrics(
            "warehouse_metering",
            total_credits="sum(credits_used)",
            total_compute_credits="sum(credits_compute)",
            total_cloud_credits="sum(credits_cloud)",
            avg_hourly_credits="avg(credits_used)",
        ),
        *_metrics(
            "query_history",
            total_queries="count(query_id)",
            avg_query_duration="avg(query_duration)",
            total_bytes_scanned="sum(bytes_scanned)",
            avg_bytes_scanned="avg(bytes_scanned)",
            failed_queries=_count_if("execution_status != 'SUCCESS'"),
            total_spill="sum(bytes_spilled_local + bytes_spilled_remote)",
        ),
    ),
)

SECURITY = SemanticView(
    "security_analytics",
    "Logins and the users behind them",
    (
        _table(
            "login_history",
            "login_history",
            ("event_id",),
            {"event_id": "event_id"},
            {
                "login_user": "user_name",
                "login_time": "event_timestamp",
                "client_ip": "client_ip",
                "client_type": "reported_client_type",
                "auth_factor": "first_authentication_factor",
                "second_auth_factor": "second_authentication_factor",
                "login_success": "is_success",
                "error_code": "error_code",
                "error_message": "error_message",
                "connection_type": "connection",
            },
            ("logins", "sign-ins"),
        ),
        _table(
            "users",
            "users",
            ("user_id",),
            dimensions={
                "user_email": "email",
                "default_role": "default_role",
                "user_disabled": "disabled",
                "has_mfa": "has_mfa",
                "user_created": "created_on",
            },
            synonyms=("accounts of people",),
        ),
    ),
    _metrics(
        "login_history",
        total_logins="count(event_id)",
        successful_logins=_count_if("login_success = 'YES'"),
        failed_logins=_count_if("login_success = 'NO'"),
        unique_users="count(DISTINCT login_user)",
        unique_ips="count(DISTINCT client_ip)",
    ),
    (Relationship("login_history", ("user_name",), "users", ("name",)),),
)

STORAGE = SemanticView(
    "storage_analytics",
    "Storage of the account, its databases and tables",
    (
        _table("storage_usage", "storage_usage", ("usage_date",), {"storage_bytes": "storage_bytes", "stage_bytes": "stage_bytes", "failsafe_bytes": "failsafe_bytes"}, {"storage_date": "usage_date"}, ("account storage",)),
        _table(
            "database_storage",
            "database_storage_usage_history",
            ("usage_date", "database_id"),
            {"db_average_bytes": "average_database_bytes", "db_failsafe_bytes": "average_failsafe_bytes"},
            {"database_name": "database_name", "db_usage_date": "usage_date"},
            ("database storage",),
        ),
        _table(
            "table_storage",
            "table_storage_metrics",
            ("id",),
            {
                "table_bytes": "active_bytes",
                "time_travel_bytes": "time_travel_bytes",
                "table_failsafe_bytes": "failsafe_bytes",
                "retained_bytes": "retained_for_clone_bytes",
            },
            {
                "table_name": "table_name",
                "table_schema": "table_schema",
                "table_catalog": "table_catalog",
                "is_transient": "is_transient",
                "table_created": "table_created",
            },
            ("table storage",),
        ),
    ),
    (
        *_metrics(
            "storage_usage",
            total_storage_bytes="sum(storage_bytes)",
            total_storage_tb=_tb("sum(storage_bytes)"),
            total_storage_gb=_gb("sum(storage_bytes)"),
            avg_daily_storage="avg(storage_bytes)",
        ),
        *_metrics("database_storage", total_db_storage="sum(db_average_bytes)"),
        *_metrics("table_storage", total_table_storage="sum(table_bytes)"),
    ),
)

GOVERNANCE = SemanticView(
    "governance_analytics",
    "Users, roles and grants",
    (
        _table(
            "users",
            "users",
            ("user_id",),
            dimensions={
                "user_name": "name",
                "login_name": "login_name",
                "user_email": "email",
                "default_warehouse": "default_warehouse",
                "default_role": "default_role",
                "user_created": "created_on",
                "user_disabled": "disabled",
                "has_mfa": "has_mfa",
                "last_success_login": "last_success_login",
            },
            synonyms=("users", "principals"),
        ),
        _table("roles", "roles", ("role_id",), dimensions={"role_name": "name", "role_owner": "owner", "role_created": "created_on"}, synonyms=("roles",)),
        _table(
            "grants_to_users",
            "grants_to_users",
            ("created_on", "role", "grantee_name"),
            dimensions={"granted_role": "role", "grantee": "grantee_name", "grant_date": "created_on"},
            synonyms=("role assignments",),
        ),
    ),
    (
        *_metrics(
            "users",
            total_users="count(DISTINCT user_id)",
            active_users=_count_if("user_disabled = 'false'"),
            mfa_users=_count_if("has_mfa = TRUE"),
        ),
        *_metrics("roles", total_roles="count(DISTINCT role_id)"),
        *_metrics("grants_to_users", total_grants="count(DISTINCT granted_role || grantee)"),
    ),
    (
        Relationship("grants_to_users", ("grantee_name",), "users", ("name",)),
        Relationship("grants_to_users", ("role",), "roles", ("name",)),
    ),
)

TASK = SemanticView(
    "task_analytics",
    "Runs of scheduled tasks",
    (
        _table(
            "task_history",
            "task_history",
            ("run_id", "name"),
            {"run_id": "run_id"},
            {
                "task_name": "name",
                "task_database": "database_name",
                "task_schema": "schema_name",
                "task_state": "state",
                "scheduled_time": "scheduled_time",
                "completed_time": "completed_time",
                "query_start": "query_start_time",
                "error_code": "error_code",
                "error_message": "error_message",
                "query_id": "query_id",
                "scheduled_from": "scheduled_from",
                "root_task_id": "root_task_id",
                "attempt_number": "attempt_number",
            },
            ("task runs",),
        ),
    ),
    _metrics(
        "task_history",
        total_runs="count(*)",
        successful_runs=_count_if("task_state = 'SUCCEEDED'"),
        failed_runs=_count_if("task_state = 'FAILED'"),
        skipped_runs=_count_if("task_state = 'SKIPPED'"),
    ),
)

BCDR = SemanticView(
    "bcdr_analytics",
    "Storage, churn and replication for recovery planning",
    (
        _table(
            "storage_usage",
            "storage_usage",
            ("usage_date",),
            {
                "active_storage_bytes": "storage_bytes",
                "stage_storage_bytes": "stage_bytes",
                "failsafe_storage_bytes": "failsafe_bytes",
            },
            {"storage_date": "usage_date"},
        ),
        _table(
            "database_storage",
            "database_storage_usage_history",
            ("usage_date", "database_id"),
            {"db_active_bytes": "average_database_bytes", "db_failsafe_bytes": "average_failsafe_bytes"},
            {"db_storage_date": "usage_date", "database_name": "database_name"},
        ),
        _table(
            "table_storage",
            "table_storage_metrics",
            ("id",),
            {
                "table_active_bytes": "active_bytes",
                "table_time_travel_bytes": "time_travel_bytes",
                "table_failsafe_bytes": "failsafe_bytes",
                "table_clone_bytes": "retained_for_clone_bytes",
            },
            {
                "table_name": "table_name",
                "table_schema": "table_schema",
                "table_catalog": "table_catalog",
                "is_transient": "is_transient",
                "table_deleted": "deleted",
                "table_created": "table_created",
            },
        ),
        _table(
            "replication_usage",
            "database_replication_usage_history",
            ("database_id", "start_time"),
            {"replication_credits": "credits_used", "bytes_replicated": "bytes_transferred"},
            {"replicated_database": "database_name", "replication_start": "start_time", "replication_end": "end_time"},
        ),
        _table(
            "replication_groups",
            "replication_groups",
            ("replication_group_id",),
            dimensions={
                "group_name": "name",
                "group_type": "type",
                "replication_schedule": "replication_schedule",
                "object_types": "object_types",
            },
        ),
    ),
    (
        *_metrics(
            "storage_usage",
            total_storage_tb=_tb("sum(active_storage_bytes)"),
            total_failsafe_tb=_tb("sum(failsafe_storage_bytes)"),
            total_billed_tb=_tb("sum(active_storage_bytes + failsafe_storage_bytes + stage_storage_bytes)"),
        ),
        *_metrics(
            "database_storage",
            total_db_storage="sum(db_active_bytes)",
            total_db_churn="sum(db_failsafe_bytes)",
            avg_db_storage_tb=_tb("avg(db_active_bytes)"),
            avg_db_churn_tb=_tb("avg(db_failsafe_bytes)"),
        ),
        *_metrics(
            "table_storage",
            table_count="count(DISTINCT id)",
            hot_table_count=_count_if("table_failsafe_bytes > 0"),
            total_table_size_gb=_gb("sum(table_active_bytes)"),
            total_time_travel_gb=_gb("sum(table_time_travel_bytes)"),
            total_table_failsafe_gb=_gb("sum(table_failsafe_bytes)"),
        ),
        *_metrics(
            "replication_usage",
            total_replication_credits="sum(replication_credits)",
            total_bytes_replicated="sum(bytes_replicated)",
            replication_count="count(DISTINCT replication_start)",
        ),
    ),
)

COST = SemanticView(
    "cost_analytics",
    "Daily credits by service and warehouse",
    (
        _table(
            "metering_daily",
            "metering_daily_history",
            ("service_type", "usage_date"),
            {
                "total_credits": "credits_used",
                "compute_credits": "credits_used_compute",
                "cloud_credits": "credits_used_cloud_services",
                "billed_credits": "credits_billed",
            },
            {"service_type": "service_type", "usage_date": "usage_date"},
        ),
        _table(
            "warehouse_metering",
            "warehouse_metering_history",
            ("start_time", "warehouse_id"),
            {"warehouse_credits": "credits_used"},
            {"warehouse_name": "warehouse_name", "metering_start": "start_time"},
        ),
    ),
    (
        *_metrics(
            "metering_daily",
            total_daily_credits="sum(total_credits)",
            total_compute="sum(compute_credits)",
            total_billed="sum(billed_credits)",
            avg_daily_credits="avg(total_credits)",
        ),
        *_metrics(
            "warehouse_metering",
            total_warehouse_credits="sum(warehouse_credits)",
            avg_warehouse_credits="avg(warehouse_credits)",
        ),
    ),
)

_SCANNED = "partitions_scanned / nullif(partitions_total, 0)"
_SPILLED = "bytes_spilled_local + bytes_spilled_remote"
_QUEUED = "queued_overload_time + queued_provisioning_time"

QUERY_PERFORMANCE = SemanticView(
    "query_performance_analytics",
    "Query speed, scans, caches, spills and queues",
    (
        _table(
            "query_history",
            "query_history",
            ("query_id",),
            {
                "total_elapsed_time": "total_elapsed_time",
                "execution_time": "execution_time",
                "compilation_time": "compilation_time",
                "queued_provisioning_time": "queued_provisioning_time",
                "queued_overload_time": "queued_overload_time",
                "queued_repair_time": "queued_repair_time",
                "transaction_blocked_time": "transaction_blocked_time",
                "bytes_scanned": "bytes_scanned",
                "bytes_written": "bytes_written",
                "bytes_written_to_result": "bytes_written_to_result",
                "rows_produced": "rows_produced",
                "rows_inserted": "rows_inserted",
                "rows_updated": "rows_updated",
                "rows_deleted": "rows_deleted",
                "partitions_scanned": "partitions_scanned",
                "partitions_total": "partitions_total",
                "cache_hit_ratio": "percentage_scanned_from_cache",
                "bytes_spilled_local": "bytes_spilled_to_local_storage",
                "bytes_spilled_remote": "bytes_spilled_to_remote_storage",
                "bytes_sent_over_network": "bytes_sent_over_the_network",
                "credits_used_cloud_services": "credits_used_cloud_services",
                "query_load_percent": "query_load_percent",
                "acceleration_bytes_scanned": "query_acceleration_bytes_scanned",
                "acceleration_partitions_scanned": "query_acceleration_partitions_scanned",
                "external_function_invocations": "external_function_total_invocations",
                "external_function_sent_rows": "external_function_total_sent_rows",
                "external_function_received_rows": "external_function_total_received_rows",
            },
            {
                "query_id": "query_id",
                "query_hash": "query_hash",
                "query_parameterized_hash": "query_parameterized_hash",
                "user_name": "user_name",
                "role_name": "role_name",
                "role_type": "role_type",
                "user_type": "user_type",
                "warehouse_name": "warehouse_name",
                "warehouse_size": "warehouse_size",
                "warehouse_type": "warehouse_type",
                "cluster_number": "cluster_number",
                "database_name": "database_name",
                "schema_name": "schema_name",
                "query_type": "query_type",
                "query_tag": "query_tag",
                "execution_status": "execution_status",
                "error_code": "error_code",
                "error_message": "error_message",
                "start_time": "start_time",
                "end_time": "end_time",
                "is_client_generated": "is_client_generated_statement",
                "session_id": "session_id",
                "release_version": "release_version",
                "query_retry_time": "query_retry_time",
                "query_retry_cause": "query_retry_cause",
            },
            ("queries",),
        ),
        _table(
            "access_history",
            "access_history",
            ("query_id",),
            dimensions={
                "query_start_time": "query_start_time",
                "access_user": "user_name",
                "direct_objects_accessed": "direct_objects_accessed",
                "base_objects_accessed": "base_objects_accessed",
                "objects_modified": "objects_modified",
                "policies_referenced": "policies_referenced",
                "parent_query_id": "parent_query_id",
                "root_query_id": "root_query_id",
            },
            synonyms=("object access",),
        ),
    ),
    _metrics(
        "query_history",
        total_queries="count(query_id)",
        successful_queries=_count_if("execution_status = 'SUCCESS'"),
        failed_queries=_count_if("execution_status != 'SUCCESS'"),
        unique_query_patterns="count(DISTINCT query_parameterized_hash)",
        avg_duration_ms="avg(total_elapsed_time)",
        max_duration_ms="max(total_elapsed_time)",
        total_duration_ms="sum(total_elapsed_time)",
        p95_duration_approx="percentile_approx(total_elapsed_time, 0.95)",
        long_running_count=_count_if("total_elapsed_time > 300000"),
        total_bytes_scanned="sum(bytes_scanned)",
        avg_bytes_scanned="avg(bytes_scanned)",
        total_rows_produced="sum(rows_produced)",
        avg_partition_scan_pct=f"avg({_SCANNED} * 100)",
        high_scan_pct_count=_count_if(f"{_SCANNED} > 0.9"),
        avg_cache_hit_ratio="avg(cache_hit_ratio)",
        low_cache_hit_count=_count_if("cache_hit_ratio < 0.2"),
        total_spill_bytes=f"sum({_SPILLED})",
        queries_with_remote_spill=_count_if("bytes_spilled_remote > 0"),
        queries_with_any_spill=_count_if(f"{_SPILLED} > 0"),
        total_queue_time=f"sum({_QUEUED})",
        avg_queue_time=f"avg({_QUEUED})",
        queries_with_high_queue=_count_if("queued_overload_time > 30000"),
        total_cloud_credits="sum(credits_used_cloud_services)",
        unique_users="count(DISTINCT user_name)",
        unique_roles="count(DISTINCT role_name)",
    ),
    (Relationship("access_history", ("query_id",), "query_history", ("query_id",)),),
)

ORGANIZATION = SemanticView(
    "organization_analytics",
    "Spend, balances and credits over all accounts",
    (
        _table(
            "usage_currency",
            "org.usage_in_currency_daily",
            ("account_name", "usage_date", "service_level", "usage_type"),
            {"usage_amount": "usage", "currency_amount": "usage_in_currency"},
            {
                "usage_date": "usage_date",
                "service_level": "service_level",
                "usage_type": "usage_type",
                "currency": "currency",
                "balance_source": "balance_source",
                "billing_type": "billing_type",
                "service_type": "service_type",
                "rating_type": "rating_type",
            },
        ),
        _table(
            "remaining_balance",
            "org.remaining_balance_daily",
            ("contract_number", "date"),
            {
                "free_usage": "free_usage_balance",
                "capacity_balance": "capacity_balance",
                "on_demand_balance": "on_demand_consumption_balance",
                "rollover": "rollover_balance",
            },
            {"contract_number": "contract_number", "balance_date": "date", "balance_currency": "currency"},
        ),
        _table(
            "metering_daily",
            "org.metering_daily_history",
            ("account_name", "service_type", "usage_date"),
            {
                "credits_used": "credits_used",
                "credits_compute": "credits_used_compute",
                "credits_cloud": "credits_used_cloud_services",
                "credits_billed": "credits_billed",
            },
            {
                "metering_account": "account_name",
                "metering_service": "service_type",
                "metering_date": "usage_date",
                "metering_region": "region",
            },
        ),
        _table(
            "warehouse_metering",
            "org.warehouse_metering_history",
            ("account_name", "warehouse_id", "start_time"),
            {
                "wh_credits": "credits_used",
                "wh_compute_credits": "credits_used_compute",
                "wh_cloud_credits": "credits_used_cloud_services",
            },
            {
                "wh_account": "account_name",
                "wh_name": "warehouse_name",
                "wh_start": "start_time",
                "wh_end": "end_time",
                "wh_service_type": "service_type",
                "wh_region": "region",
            },
        ),
        _table(
            "accounts",
            "org.accounts",
            ("account_name",),
            dimensions={
                "account_name": "account_name",
                "account_locator": "account_locator",
                "region": "region",
                "region_group": "region_group",
                "edition": "edition",
                "is_org_admin": "is_org_admin",
                "is_locked": "is_locked",
                "account_created": "created_on",
                "account_url": "account_url",
            },
        ),
    ),
    (
        *_metrics(
            "usage_currency",
            total_spend="sum(currency_amount)",
            total_credits="sum(usage_amount)",
            avg_daily_spend="avg(currency_amount)",
        ),
        *_metrics("remaining_balance", latest_capacity="max(capacity_balance)", latest_on_demand="max(on_demand_balance)"),
        *_metrics(
            "metering_daily",
            total_org_credits="sum(credits_used)",
            total_org_billed="sum(credits_billed)",
            account_count="count(DISTINCT metering_account)",
        ),
        *_metrics(
            "warehouse_metering",
            total_wh_credits="sum(wh_credits)",
            warehouse_count="count(DISTINCT wh_name)",
            avg_wh_credits="avg(wh_credits)",
        ),
    ),
    (
        Relationship("usage_currency", ("account_name",), "accounts", ("account_name",)),
        Relationship("metering_daily", ("account_name",), "accounts", ("account_name",)),
        Relationship("warehouse_metering", ("account_name",), "accounts", ("account_name",)),
    ),
)

VIEWS: dict[str, SemanticView] = {
    v.name: v
    for v in (
        SERVERLESS_COST,
        WAREHOUSE_COST,
        SECURITY,
        STORAGE,
        GOVERNANCE,
        TASK,
        BCDR,
        COST,
        QUERY_PERFORMANCE,
        ORGANIZATION,
    )
}
