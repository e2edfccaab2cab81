"""The usage reports over archives of the derived sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import ASOF_EVENTS, ASOF_LINES, ASOF_ORDERS, WHOLE_TEXT
from checks.lab import FIRST, METERING_LAST, SECOND, lab
from checks.registry import check, r
from yearring.functions.documents import document, document_quality, field, typed
from yearring.operators.rollup import RANK_ERROR
from yearring.plans import audit, cost, performance, security, storage, tasks
from yearring.plans.rollups import DAILY_CREDITS, HOURLY_QUERIES, MONTHLY_CHARGES

GB, TB = "1073741824.0::DOUBLE", "1099511627776.0::DOUBLE"
E, O, L = (f"TIMESTAMP '{t}'" for t in (ASOF_EVENTS, ASOF_ORDERS, ASOF_LINES))
CREDITS = f"""{r('SUM(credits_used)', 2)} AS total_credits, {r('SUM(credits_used_compute)', 2)} AS compute_credits,
    {r('SUM(credits_used_cloud_services)', 2)} AS cloud_credits"""


def days(asof: str, n: int) -> str:
    return f"(CAST({asof} AS DATE) - {n})"


# ---- cost -----------------------------------------------------------------

# Each month has one of three grades; the sets are written apart and cover all months.
check(
    "wh_rightsizing",
    f"""
    WITH m AS (SELECT warehouse_name, date_trunc('month', start_time)::TIMESTAMP AS month, SUM(avg_running) / COUNT(avg_running) AS running,
            SUM(avg_queued_load) / COUNT(avg_queued_load) AS queued, SUM(credits_used) AS credits FROM warehouse_metering GROUP BY ALL),
    idle AS (SELECT *, '{cost.IDLE}' AS grade FROM m WHERE running < 2 AND queued < 0.1),
    crowded AS (SELECT *, '{cost.CROWDED}' AS grade FROM m WHERE queued > 1),
    graded AS (FROM idle UNION ALL FROM crowded)
    SELECT warehouse_name, month, {r('m.running')} AS avg_concurrent_queries, {r('m.queued')} AS avg_queue_depth,
        {r('m.credits')} AS monthly_credits, COALESCE(g.grade, '{cost.FITTING}') AS recommendation
    FROM m LEFT JOIN graded g USING (warehouse_name, month)""",
)(lambda s, d: cost.warehouse_rightsizing(lab(s, d).read("warehouse_metering")))

check(
    "cost_attribution_qoq",
    f"""
    WITH q AS (SELECT user_name, role_name, date_trunc('quarter', start_time)::TIMESTAMP AS quarter, COUNT(*) AS query_count,
            SUM(total_elapsed_time) / 1000 / 60 AS total_minutes, SUM(credits_used_cloud_services) AS cloud_credits
        FROM query_history GROUP BY 1, 2, 3),
    p AS (SELECT *, LAG(cloud_credits) OVER (PARTITION BY user_name ORDER BY quarter, role_name) AS prev FROM q)
    SELECT user_name, role_name, quarter, query_count, {r('total_minutes')} AS total_minutes,
        {r('cloud_credits')} AS cloud_credits, {r('prev')} AS prev_quarter_credits,
        {r('(cloud_credits - prev) / NULLIF(prev, 0) * 100', 2)} AS qoq_change_pct FROM p""",
)(lambda s, d: cost.cost_attribution(lab(s, d).read("query_history")))

# The events span one month, so the access log (orders) shows several quarters.
check(
    "cost_attribution_qoq_years",
    f"""
    WITH q AS (SELECT user_name, role_name, date_trunc('quarter', start_time)::TIMESTAMP AS quarter, COUNT(*) AS query_count,
            SUM(bytes_scanned) / 1000 / 60 AS total_minutes, SUM(CAST(rows_inserted AS DOUBLE)) AS cloud_credits
        FROM access_log GROUP BY 1, 2, 3),
    p AS (SELECT *, LAG(cloud_credits) OVER (PARTITION BY user_name ORDER BY quarter, role_name) AS prev FROM q)
    SELECT user_name, role_name, quarter, query_count, {r('total_minutes')} AS total_minutes,
        {r('cloud_credits')} AS cloud_credits, {r('prev')} AS prev_quarter_credits,
        {r('(cloud_credits - prev) / NULLIF(prev, 0) * 100', 2)} AS qoq_change_pct FROM p""",
)(
    lambda s, d: cost.cost_attribution(
        lab(s, d)
        .read("access_log")
        .selectExpr("*", "bytes_scanned AS total_elapsed_time", "CAST(rows_inserted AS DOUBLE) AS credits_used_cloud_services")
    )
)

check(
    "top_warehouses",
    f"""
    SELECT warehouse_name, {CREDITS}, COUNT(*) AS metering_periods FROM warehouse_metering
    WHERE start_time >= TIMESTAMP '2001-10-01' AND start_time < TIMESTAMP '2001-11-01' GROUP BY 1""",
)(lambda s, d: cost.top_warehouses(lab(s, d).read("warehouse_metering"), ASOF_LINES))

check(
    "credits_by_month",
    f"""
    SELECT date_trunc('month', start_time)::TIMESTAMP AS month, warehouse_name, {r('SUM(credits_used)')} AS total_credits
    FROM warehouse_metering GROUP BY 1, 2 ORDER BY month DESC, total_credits DESC, warehouse_name LIMIT 100""",
)(lambda s, d: cost.credits_by_month(lab(s, d).read("warehouse_metering")))

check(
    "credits_by_day",
    f"""
    SELECT warehouse_name, date_trunc('day', start_time)::TIMESTAMP AS usage_date, {CREDITS}
    FROM warehouse_metering WHERE start_time >= {days(L, 30)} GROUP BY 1, 2
    ORDER BY usage_date DESC, total_credits DESC, warehouse_name LIMIT 50""",
)(lambda s, d: cost.credits_by_day(lab(s, d).read("warehouse_metering"), ASOF_LINES))

check(
    "daily_credit_summary",
    f"""
    SELECT date_trunc('day', start_time)::TIMESTAMP AS day, warehouse_name, {r('SUM(credits_used)')} AS daily_credits
    FROM warehouse_metering GROUP BY 1, 2""",
)(
    lambda s, d: cost.refresh_daily_credit_summary(
        lab(s, d).read("warehouse_metering"), f"{lab(s, d).store.root}-summaries/daily_credits"
    )
)

check(
    "top_consumers",
    f"""
    SELECT user_name, role_name, warehouse_name, COUNT(*) AS query_count,
        {r('SUM(total_elapsed_time) / 1000 / 60', 2)} AS total_minutes,
        {r('SUM(credits_used_cloud_services)', 4)} AS cloud_credits
    FROM query_history WHERE start_time >= {days(E, 30)} GROUP BY 1, 2, 3
    ORDER BY cloud_credits DESC, user_name, role_name, warehouse_name LIMIT 25""",
)(lambda s, d: cost.top_consumers(lab(s, d).read("query_history"), ASOF_EVENTS))

check(
    "dt_refresh_costs",
    f"""
    SELECT name AS dt_name, database_name, schema_name, state, COUNT(*) AS refresh_count,
        CAST(SUM(CASE WHEN state = 'SUCCEEDED' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
        CAST(SUM(CASE WHEN state IN ('FAILED', 'UPSTREAM_FAILED') THEN 1 ELSE 0 END) AS BIGINT) AS failures,
        {r('AVG(target_lag_sec)')} AS avg_target_lag_sec
    FROM dynamic_table_refresh WHERE refresh_start_time >= {days(O, 7)} GROUP BY 1, 2, 3, 4""",
)(lambda s, d: cost.refresh_costs(lab(s, d).read("dynamic_table_refresh"), ASOF_ORDERS))

check(
    "serverless_tasks",
    f"""
    SELECT task_name, database_name, schema_name, {r('SUM(credits_used)', 4)} AS total_credits,
        COUNT(*) AS execution_count, {r('AVG(credits_used)')} AS avg_credits_per_run
    FROM serverless_task WHERE start_time >= {days(L, 30)} GROUP BY 1, 2, 3
    ORDER BY total_credits DESC, task_name, database_name, schema_name LIMIT 20""",
)(lambda s, d: cost.serverless_tasks(lab(s, d).read("serverless_task"), ASOF_LINES))

check(
    "daily_cost_by_service",
    f"""
    SELECT usage_date, service_type, {CREDITS}, {r('SUM(credits_billed)', 2)} AS billed_credits
    FROM metering_daily WHERE usage_date >= {days(L, 30)} GROUP BY 1, 2""",
)(lambda s, d: cost.daily_cost_by_service(lab(s, d).read("metering_daily"), ASOF_LINES))

check(
    "contract_balance",
    f"""
    SELECT contract_number, currency,
        {r('SUM(free_usage_balance + capacity_balance + on_demand_consumption_balance + rollover_balance)', 2)} AS total_remaining_balance,
        date
    FROM remaining_balance WHERE date >= {days(O, 30)} GROUP BY contract_number, currency, date
    ORDER BY date DESC, contract_number, currency LIMIT 30""",
)(lambda s, d: cost.contract_balance(lab(s, d).read("remaining_balance"), ASOF_ORDERS))

check(
    "org_warehouse_credits",
    f"""
    SELECT account_name, warehouse_name, {CREDITS} FROM warehouse_metering WHERE start_time >= {days(L, 30)}
    GROUP BY 1, 2 ORDER BY total_credits DESC, account_name, warehouse_name LIMIT 25""",
)(lambda s, d: cost.org_warehouse_credits(lab(s, d).read("warehouse_metering"), ASOF_LINES))

check(
    "org_storage",
    f"""
    SELECT account_name, {r(f'AVG(storage_bytes) / {TB}', 2)} AS avg_storage_tb,
        {r(f'AVG(stage_bytes) / {TB}', 2)} AS avg_stage_tb, {r(f'AVG(failsafe_bytes) / {TB}', 2)} AS avg_failsafe_tb
    FROM org_storage WHERE usage_date >= {days(O, 30)} GROUP BY 1""",
)(lambda s, d: storage.org_storage(lab(s, d).read("org_storage"), ASOF_ORDERS))

check(
    "recent_partition_scan",
    "SELECT query_id, user_name, start_time FROM query_history WHERE start_time >= TIMESTAMP '2023-12-31'",
)(lambda s, d: cost.recent_rows(lab(s, d).read("query_history"), ASOF_EVENTS).select("query_id", "user_name", "start_time"))

# ---- security -------------------------------------------------------------

check(
    "login_patterns",
    f"""
    SELECT user_name, client_ip, reported_client_type, date_trunc('month', event_timestamp)::TIMESTAMP AS month,
        COUNT(*) AS login_count, COUNT(DISTINCT date_trunc('day', event_timestamp)) AS active_days,
        MIN(event_timestamp) AS first_login, MAX(event_timestamp) AS last_login,
        CASE WHEN MAX(event_timestamp) < {E} - INTERVAL 10 DAY THEN 'DORMANT - Review for deactivation' ELSE 'ACTIVE' END AS account_status
    FROM login_history WHERE is_success = 'YES' GROUP BY 1, 2, 3, 4""",
)(lambda s, d: security.login_patterns(lab(s, d).read("login_history"), ASOF_EVENTS, dormant_days=10))

check(
    "failed_logins_24h",
    """
    SELECT event_id, event_timestamp, user_name, client_ip, reported_client_type, error_code, error_message,
        first_authentication_factor, second_authentication_factor,
        COUNT(*) OVER (PARTITION BY user_name ORDER BY event_timestamp
            RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS failed_attempts_24h
    FROM login_history WHERE is_success = 'NO'""",
)(lambda s, d: security.failed_logins_24h(lab(s, d).read("login_history")))

check(
    "brute_force",
    f"""
    SELECT client_ip, user_name, reported_client_type, COUNT(*) AS failed_attempts, MIN(event_timestamp) AS first_attempt,
        MAX(event_timestamp) AS last_attempt, date_diff('minute', MIN(event_timestamp), MAX(event_timestamp)) AS window_minutes
    FROM login_history WHERE is_success = 'NO' AND event_timestamp >= {days(E, 7)}
    GROUP BY 1, 2, 3 HAVING COUNT(*) >= 5""",
)(lambda s, d: security.brute_force(lab(s, d).read("login_history"), ASOF_EVENTS))

check(
    "failed_login_summary",
    f"""
    SELECT user_name, client_ip, reported_client_type, error_code, error_message, COUNT(*) AS failure_count,
        MIN(event_timestamp) AS first_failure, MAX(event_timestamp) AS last_failure
    FROM login_history WHERE is_success = 'NO' AND event_timestamp >= {days(E, 7)} GROUP BY 1, 2, 3, 4, 5
    ORDER BY failure_count DESC, user_name, client_ip, reported_client_type, error_code, error_message LIMIT 20""",
)(lambda s, d: security.failed_login_summary(lab(s, d).read("login_history"), ASOF_EVENTS))

check(
    "failed_login_list",
    """
    SELECT user_name, client_ip, error_code, error_message, event_timestamp FROM login_history
    WHERE is_success = 'NO' ORDER BY event_timestamp DESC, event_id LIMIT 100""",
)(lambda s, d: security.failed_login_list(lab(s, d).read("login_history")))

check(
    "login_by_user",
    """
    SELECT user_name, COUNT(*) AS login_count, CAST(SUM(CASE WHEN is_success = 'YES' THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
        CAST(SUM(CASE WHEN is_success = 'NO' THEN 1 ELSE 0 END) AS BIGINT) AS failure_count
    FROM login_history GROUP BY 1 ORDER BY login_count DESC, user_name LIMIT 50""",
)(lambda s, d: security.login_by_user(lab(s, d).read("login_history")))

_MFA = f"""
    SELECT name AS user_name, email, default_role, has_mfa, last_success_login, disabled,
        CAST(date_diff('day', last_success_login, {E}) AS INT) AS days_since_login
    FROM users WHERE (has_mfa = FALSE OR has_mfa IS NULL) AND disabled = 'false'"""
check("mfa_missing", _MFA)(lambda s, d: security.mfa_missing(lab(s, d).read("users"), ASOF_EVENTS))
check("mfa_missing_top50", _MFA + " ORDER BY last_success_login DESC, name LIMIT 50")(
    lambda s, d: security.mfa_missing(lab(s, d).read("users"), ASOF_EVENTS, limit=50)
)

check(
    "dormant_users",
    f"""
    SELECT name AS user_name, email, default_role, last_success_login,
        CAST(date_diff('day', last_success_login, {E}) AS INT) AS days_inactive, disabled, has_mfa
    FROM users WHERE disabled = 'false' AND last_success_login < {E} - INTERVAL 90 DAY""",
)(lambda s, d: security.dormant_users(lab(s, d).read("users"), ASOF_EVENTS))

check(
    "admins",
    """
    SELECT g.grantee_name AS user_name, g.role AS granted_role, g.granted_by, g.created_on AS grant_date,
        u.email, u.has_mfa, u.last_success_login, u.disabled
    FROM grants_to_users g LEFT JOIN users u ON g.grantee_name = u.name WHERE g.role = 'NATION_0'""",
)(lambda s, d: security.admins(lab(s, d).read("grants_to_users"), lab(s, d).read("users"), "NATION_0"))

# ---- audit ----------------------------------------------------------------

check(
    "privilege_evolution",
    f"""
    WITH v AS (
        SELECT grantee_name, role, granted_by, created_on, TIMESTAMP '{FIRST}' AS f, TIMESTAMP '9999-12-31 23:59:59' AS t, TRUE AS c
        FROM grants_to_users WHERE granted_by <> 'G3'
        UNION ALL SELECT grantee_name, role, 'G9', created_on, TIMESTAMP '{FIRST}', TIMESTAMP '{SECOND}', FALSE
        FROM grants_to_users WHERE granted_by = 'G3'
        UNION ALL SELECT grantee_name, role, granted_by, created_on, TIMESTAMP '{SECOND}', TIMESTAMP '9999-12-31 23:59:59', TRUE
        FROM grants_to_users WHERE granted_by = 'G3')
    SELECT grantee_name, role, granted_by, f AS privilege_granted_at, t AS privilege_revoked_at, c AS currently_active,
        CAST(date_diff('day', f, CASE WHEN c THEN TIMESTAMP '2024-03-01' ELSE t END) AS INT) AS days_with_privilege
    FROM v WHERE grantee_name = 'Customer#000000003'""",
)(
    lambda s, d: audit.privilege_evolution(
        lab(s, d).read("grants_to_users", None), "Customer#000000003", "2024-03-01 00:00:00"
    )
)

check(
    "compliance_evidence",
    f"""
    SELECT 'DATA_ACCESS_AUDIT' AS report_type, user_name, role_name, database_name || '.' || schema_name AS data_location,
        query_type, start_time AS access_timestamp, execution_status, rows_produced AS records_accessed,
        CASE WHEN start_time < TIMESTAMP '2024-01-11' THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS archived_at,
        64 AS hash_length, 'SOURCE_usage' AS source
    FROM query_history WHERE database_name IN ('PRODUCTION', 'CUSTOMER_DATA', 'FINANCIAL')
        AND start_time >= {E} - INTERVAL 7 YEAR""",
)(
    lambda s, d: audit.compliance_evidence(
        lab(s, d).read("query_history"), ["PRODUCTION", "CUSTOMER_DATA", "FINANCIAL"], ASOF_EVENTS
    )
    .selectExpr("*", "length(integrity_hash) AS hash_length")
    .drop("integrity_hash")
)

check(
    "data_access_ilike",
    f"""
    SELECT user_name, role_name, query_text, database_name, schema_name, start_time, rows_produced,
        {r(f'bytes_scanned / {GB}')} AS gb_scanned
    FROM query_history WHERE query_text ILIKE '%CUSTOMER_PII%' AND start_time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'""",
)(
    lambda s, d: audit.data_access(
        lab(s, d).read("query_history"), "%CUSTOMER_PII%", "2024-01-03 00:00:00", "2024-01-25 00:00:00"
    )
)

check(
    "data_access_indexed",
    f"""
    SELECT user_name, role_name, query_text, database_name, schema_name, start_time, rows_produced,
        {r(f'bytes_scanned / {GB}')} AS gb_scanned
    FROM query_history WHERE query_text ILIKE '%er_PII' AND start_time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'""",
)(lambda s, d: audit.data_access(lab(s, d).text_index().search("%er_PII", "open"), "%er_PII", "2024-01-03 00:00:00", "2024-01-25 00:00:00"))

check(
    "change_audit",
    f"""
    WITH v AS (
        SELECT *, TIMESTAMP '{FIRST}' AS f, TIMESTAMP '9999-12-31 23:59:59' AS t, TRUE AS c FROM users WHERE user_id % 10 NOT IN (3, 9)
        UNION ALL SELECT * REPLACE ('OLD_ROLE' AS default_role), TIMESTAMP '{FIRST}', TIMESTAMP '{SECOND}', FALSE FROM users WHERE user_id % 10 = 3
        UNION ALL SELECT *, TIMESTAMP '{SECOND}', TIMESTAMP '9999-12-31 23:59:59', TRUE FROM users WHERE user_id % 10 IN (3, 9))
    SELECT name AS database_name, default_role AS database_owner, last_success_login AS originally_created, f AS this_version_from,
        t AS this_version_to, c AS is_current_state, email AS comment, disabled AS options
    FROM v WHERE name = 'Customer#000000013'""",
)(
    lambda s, d: audit.change_audit(
        lab(s, d)
        .read("users", None)
        .withColumnsRenamed(
            {
                "name": "database_name",
                "default_role": "database_owner",
                "last_success_login": "created",
                "email": "comment",
                "disabled": "options",
            }
        ),
        "Customer#000000013",
    )
)

# ---- performance ----------------------------------------------------------

_SCAN = "partitions_scanned / NULLIF(partitions_total, 0)"

# The months before a month are found by their rank, at most twelve of them.
check(
    "query_anomalies",
    f"""
    WITH months AS (SELECT user_name, date_trunc('month', start_time)::TIMESTAMP AS month, COUNT(*) AS n, CAST(SUM(bytes_scanned) AS BIGINT) AS bytes
            FROM access_log GROUP BY ALL),
    ranked AS (SELECT *, RANK() OVER (PARTITION BY user_name ORDER BY month) AS place FROM months),
    known AS (SELECT now.user_name, now.month, now.n, now.bytes, AVG(past.n) AS mean, STDDEV_SAMP(past.n) AS sigma
        FROM ranked now LEFT JOIN ranked past ON past.user_name = now.user_name AND now.place - past.place BETWEEN 1 AND 12 GROUP BY ALL)
    SELECT user_name, month, n AS query_count, bytes AS total_bytes, {r('mean')} AS avg_query_count_12mo, {r('sigma')} AS stddev_query_count_12mo,
        COALESCE(CASE SIGN(n - mean) * CAST(ABS(n - mean) > 3 * sigma AS INT) WHEN 1 THEN '{performance.UNUSUAL_HIGH}'
            WHEN -1 THEN '{performance.UNUSUAL_LOW}' END, '{performance.USUAL}') AS anomaly_flag
    FROM known WHERE month >= TIMESTAMP '2001-02-02'""",
)(lambda s, d: performance.query_anomalies(lab(s, d).read("access_log"), ASOF_ORDERS))

check(
    "long_running",
    f"""
    SELECT query_id, user_name, role_name, warehouse_name, warehouse_size, query_type,
        {r('total_elapsed_time / 1000 / 60')} AS duration_minutes, {r(f'bytes_scanned / {GB}')} AS gb_scanned,
        partitions_scanned, partitions_total,
        {r('partitions_scanned * 100.0::DOUBLE / NULLIF(partitions_total, 0)', 2)} AS partition_scan_pct, execution_status, start_time
    FROM query_history WHERE total_elapsed_time > 300000 ORDER BY total_elapsed_time DESC, query_id LIMIT 50""",
)(lambda s, d: performance.long_running(lab(s, d).read("query_history")))

check(
    "long_running_7d",
    f"""
    SELECT query_id, user_name, warehouse_name, warehouse_size, query_type, {r('total_elapsed_time / 1000 / 60', 2)} AS duration_minutes,
        {r(f'bytes_scanned / {GB}', 2)} AS gb_scanned, execution_status, start_time
    FROM query_history WHERE total_elapsed_time > 300000 AND start_time >= {days(E, 7)}
    ORDER BY total_elapsed_time DESC, query_id LIMIT 20""",
)(lambda s, d: performance.long_running_recent(lab(s, d).read("query_history"), ASOF_EVENTS))

check(
    "high_partition_scan",
    f"""
    SELECT query_parameterized_hash, COUNT(*) AS execution_count, {r('AVG(total_elapsed_time) / 1000')} AS avg_duration_sec,
        {r('AVG(partitions_scanned * 100.0::DOUBLE / NULLIF(partitions_total, 0))')} AS avg_scan_pct, MAX(partitions_total) AS max_partitions,
        {r(f'SUM(bytes_scanned) / {TB}')} AS total_tb_scanned,
        string_agg(DISTINCT database_name || '.' || schema_name, ', ' ORDER BY database_name || '.' || schema_name) AS databases_accessed
    FROM query_history WHERE partitions_total > 100 AND {_SCAN} > 0.9 AND start_time >= {days(E, 30)}
    GROUP BY 1 ORDER BY SUM(bytes_scanned) DESC, query_parameterized_hash LIMIT 20""",
)(lambda s, d: performance.high_partition_scan(lab(s, d).read("query_history"), ASOF_EVENTS))

check(
    "high_partition_scan_user",
    f"""
    SELECT user_name, warehouse_name, query_parameterized_hash, COUNT(*) AS execution_count, {r(f'AVG({_SCAN} * 100)')} AS avg_scan_pct,
        {r('AVG(total_elapsed_time / 1000)')} AS avg_duration_seconds, {r(f'SUM(bytes_scanned) / {GB}')} AS total_gb_scanned
    FROM query_history WHERE partitions_total > 100 AND {_SCAN} > 0.9 AND start_time >= {days(E, 30)}
    GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2
    ORDER BY SUM(bytes_scanned) DESC, user_name, warehouse_name, query_parameterized_hash LIMIT 20""",
)(lambda s, d: performance.high_partition_scan_by_user(lab(s, d).read("query_history"), ASOF_EVENTS, days=30, least=2))

_SPILL_GRADE_ROWS = ", ".join(f"({2 - k}, '{label}')" for k, label in enumerate(performance.SPILL_GRADES))
check(
    "spill_queries",
    f"""
    WITH grades(level, recommendation) AS (VALUES {_SPILL_GRADE_ROWS}),
    spilled AS (SELECT *, bytes_spilled_to_local_storage AS near, bytes_spilled_to_remote_storage AS far FROM query_history),
    top AS (FROM spilled WHERE near > 0 OR far > 0 ORDER BY far DESC, near DESC, query_id LIMIT 50)
    SELECT user_name, warehouse_name, warehouse_size, query_type, query_id, {r('total_elapsed_time / 1000')} AS duration_sec,
        {r(f'near / {GB}')} AS local_spill_gb, {r(f'far / {GB}')} AS remote_spill_gb, {r(f'bytes_scanned / {GB}')} AS gb_scanned, recommendation, start_time
    FROM top JOIN grades ON level = GREATEST(CAST(far > 0 AS INT) * 2, CAST(near > 1073741824 AS INT))""",
)(lambda s, d: performance.spill_queries(lab(s, d).read("query_history")))

check(
    "spill_by_user",
    f"""
    SELECT user_name, warehouse_name, warehouse_size, COUNT(*) AS spill_count,
        {r(f'SUM(bytes_spilled_to_remote_storage) / {GB}', 2)} AS total_remote_spill_gb,
        {r('AVG(total_elapsed_time) / 1000', 2)} AS avg_duration_seconds
    FROM query_history WHERE bytes_spilled_to_remote_storage > 0 AND start_time >= {days(E, 30)} GROUP BY 1, 2, 3
    ORDER BY total_remote_spill_gb DESC, user_name, warehouse_name, warehouse_size LIMIT 10""",
)(lambda s, d: performance.spill_by_user(lab(s, d).read("query_history"), ASOF_EVENTS))

check(
    "remote_spill_7d",
    f"""
    SELECT user_name, warehouse_name, warehouse_size, query_id, {r('total_elapsed_time / 1000', 2)} AS duration_sec,
        {r(f'bytes_spilled_to_remote_storage / {GB}', 2)} AS remote_spill_gb, {r(f'bytes_spilled_to_local_storage / {GB}', 2)} AS local_spill_gb, start_time
    FROM query_history WHERE bytes_spilled_to_remote_storage > 0 AND start_time >= {days(E, 7)}
    ORDER BY bytes_spilled_to_remote_storage DESC, query_id LIMIT 20""",
)(lambda s, d: performance.remote_spill_recent(lab(s, d).read("query_history"), ASOF_EVENTS))

_QUEUE_GRADES = ", ".join(f"'{label}'" for label in performance.QUEUE_GRADES)


def queue_hours(rows: str) -> str:
    """Hours of ``rows`` whose mean wait is above five seconds; each passed limit moves the grade one place to the front."""
    return f"""
    WITH h AS (SELECT warehouse_name, date_trunc('hour', start_time)::TIMESTAMP AS hour, COUNT(*) AS n, MAX(queued_overload_time) AS worst,
            COUNT(*) FILTER (queued_overload_time > 30000) AS waiting, SUM(queued_overload_time) / COUNT(queued_overload_time) AS mean
        FROM {rows} GROUP BY ALL)
    SELECT warehouse_name, hour, n AS query_count, waiting AS high_queue_count, {r('mean / 1000')} AS avg_queue_sec,
        {r('worst / 1000')} AS max_queue_sec, {r('waiting * 100.0::DOUBLE / n', 2)} AS pct_queued,
        ([{_QUEUE_GRADES}])[3 - CAST(mean > 30000 AS INT) - CAST(mean > 60000 AS INT)] AS recommendation
    FROM h WHERE mean > 5000"""


check(
    "queue_time_hourly",
    queue_hours(f"(FROM query_history WHERE start_time >= {days(E, 7)})"),
)(lambda s, d: performance.queue_time_hourly(lab(s, d).read("query_history"), ASOF_EVENTS))

_JOINED = """qh AS (SELECT * FROM access_log WHERE start_time >= {since}),
    f AS (SELECT query_id, UNNEST({array}) AS item FROM access_history)"""
check(
    "user_table_access",
    f"""
    WITH {_JOINED.format(since=days(O, 365), array='direct_objects_accessed')}
    SELECT user_name, role_name, item.objectName AS table_accessed, item.objectDomain AS object_type, COUNT(*) AS access_count,
        MIN(start_time) AS first_access, MAX(start_time) AS last_access, {r(f'SUM(bytes_scanned) / {GB}')} AS total_gb_scanned
    FROM qh JOIN f USING (query_id) WHERE item.objectDomain = 'Table' GROUP BY 1, 2, 3, 4
    ORDER BY access_count DESC, user_name, role_name, table_accessed, object_type LIMIT 100""",
)(
    lambda s, d: performance.user_table_access(
        lab(s, d).read("access_log"), lab(s, d).read("access_history"), ASOF_ORDERS, days=365
    )
)

check(
    "user_table_access_min5",
    f"""
    WITH f AS (SELECT user_name, query_start_time, UNNEST(direct_objects_accessed) AS item FROM access_history
               WHERE query_start_time >= {days(L, 365)})
    SELECT user_name, item.objectName AS table_accessed, item.objectDomain AS object_type, COUNT(*) AS access_count,
        MIN(query_start_time) AS first_access, MAX(query_start_time) AS last_access
    FROM f GROUP BY 1, 2, 3 HAVING COUNT(*) >= 5
    ORDER BY access_count DESC, user_name, table_accessed, object_type LIMIT 20""",
)(lambda s, d: performance.user_table_access_repeated(lab(s, d).read("access_history"), ASOF_LINES, days=365))

check(
    "lineage_modified",
    f"""
    WITH {_JOINED.format(since=days(O, 90), array='objects_modified')}
    SELECT user_name, role_name, query_type, item.objectName AS table_modified,
        '["' || array_to_string(item.columns, '","') || '"]' AS columns_modified, COUNT(*) AS modification_count,
        CAST(SUM(rows_inserted) AS BIGINT) AS total_rows_inserted, CAST(SUM(rows_updated) AS BIGINT) AS total_rows_updated,
        CAST(SUM(rows_deleted) AS BIGINT) AS total_rows_deleted, MIN(start_time) AS first_modification, MAX(start_time) AS last_modification
    FROM qh JOIN f USING (query_id) GROUP BY 1, 2, 3, 4, 5""",
)(
    lambda s, d: performance.lineage_modified(
        lab(s, d).read("access_log"), lab(s, d).read("access_history"), ASOF_ORDERS, days=90
    )
)

# The same reports over access rows kept as JSON text; rows whose text is no array take no part.
_TEXTS = _JOINED.replace("FROM access_history)", f"FROM access_history WHERE {WHOLE_TEXT})")
check(
    "user_table_access_json",
    f"""
    WITH {_TEXTS.format(since=days(O, 365), array='direct_objects_accessed')}
    SELECT user_name, role_name, item.objectName AS table_accessed, item.objectDomain AS object_type, COUNT(*) AS access_count,
        MIN(start_time) AS first_access, MAX(start_time) AS last_access, {r(f'SUM(bytes_scanned) / {GB}')} AS total_gb_scanned
    FROM qh JOIN f USING (query_id) WHERE item.objectDomain = 'Table' GROUP BY 1, 2, 3, 4
    ORDER BY access_count DESC, user_name, role_name, table_accessed, object_type LIMIT 100""",
)(lambda s, d: performance.user_table_access(lab(s, d).read("access_log"), lab(s, d).texts().read("open"), ASOF_ORDERS, days=365))

check(
    "lineage_modified_json",
    f"""
    WITH {_TEXTS.format(since=days(O, 90), array='objects_modified')}
    SELECT user_name, role_name, query_type, item.objectName AS table_modified,
        '["' || array_to_string(item.columns, '","') || '"]' AS columns_modified, COUNT(*) AS modification_count,
        CAST(SUM(rows_inserted) AS BIGINT) AS total_rows_inserted, CAST(SUM(rows_updated) AS BIGINT) AS total_rows_updated,
        CAST(SUM(rows_deleted) AS BIGINT) AS total_rows_deleted, MIN(start_time) AS first_modification, MAX(start_time) AS last_modification
    FROM qh JOIN f USING (query_id) GROUP BY 1, 2, 3, 4, 5""",
)(lambda s, d: performance.lineage_modified(lab(s, d).read("access_log"), lab(s, d).texts().read("open"), ASOF_ORDERS, days=90))

_QUALITY = """SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(CASE WHEN m = 1 THEN 1 END) AS null_texts, COUNT(CASE WHEN m = 0 THEN 1 END) AS malformed, COUNT(CASE WHEN m = 3 THEN 1 END) AS arrays,
        COUNT(CASE WHEN m = 2 THEN 1 END) AS others, CAST(COALESCE(SUM(CASE WHEN m = 3 THEN len({c}) END), 0) AS BIGINT) AS elements
    FROM (SELECT *, CASE WHEN query_id % 97 = 0 THEN 0 WHEN query_id % 89 = 0 THEN 1 WHEN query_id % 83 = 0 THEN 2 ELSE 3 END AS m FROM access_history)"""
check("document_quality", " UNION ALL ".join(_QUALITY.format(c=c) for c in ("direct_objects_accessed", "objects_modified")))(
    lambda s, d: document_quality(lab(s, d).texts().read("open"), ["direct_objects_accessed", "objects_modified"])
)

check(
    "document_fields",
    f"""
    SELECT query_id, direct_objects_accessed[1].objectName AS first_object, direct_objects_accessed[2].columns[1] AS second_column,
        len(direct_objects_accessed) AS objects, CAST(NULL AS BIGINT) AS wrong_type
    FROM access_history WHERE {WHOLE_TEXT}
    UNION ALL SELECT query_id, NULL, NULL, NULL, NULL FROM access_history WHERE NOT ({WHOLE_TEXT})""",
)(
    lambda s, d: lab(s, d)
    .texts()
    .read("open")
    .select("query_id", document("direct_objects_accessed").alias("doc"), typed("direct_objects_accessed", "array<struct<objectName: string>>").alias("objects"))
    .select(
        "query_id",
        field("doc", "$[0].objectName").alias("first_object"),
        field("doc", "$[1].columns[0]").alias("second_column"),
        F.size("objects").cast("long").alias("objects"),
        field("doc", "$[0].objectName", "bigint").alias("wrong_type"),
    )
)

check(
    "policy_access",
    f"""
    WITH {_JOINED.format(since=days(O, 90), array='policies_referenced')}
    SELECT user_name, role_name, query_type, item.policyName AS policy_name, item.policyKind AS policy_type,
        COUNT(*) AS access_count, MIN(start_time) AS first_access, MAX(start_time) AS last_access
    FROM qh JOIN f USING (query_id) GROUP BY 1, 2, 3, 4, 5""",
)(
    lambda s, d: performance.policy_access(lab(s, d).read("access_log"), lab(s, d).read("access_history"), ASOF_ORDERS)
)

check(
    "cache_efficiency",
    f"""
    SELECT warehouse_name, CAST(EXTRACT(HOUR FROM start_time) AS INT) AS hour_of_day, COUNT(*) AS query_count,
        {r('AVG(percentage_scanned_from_cache) * 100')} AS avg_cache_hit_pct,
        CAST(SUM(CASE WHEN percentage_scanned_from_cache < 0.2 THEN 1 ELSE 0 END) AS BIGINT) AS low_cache_queries,
        {r(f'SUM(bytes_scanned) / {TB}')} AS total_tb_scanned,
        {r(f'SUM(bytes_scanned * (1 - percentage_scanned_from_cache)) / {TB}')} AS tb_from_storage
    FROM query_history WHERE start_time >= {days(E, 7)} AND bytes_scanned > 0 GROUP BY 1, 2""",
)(lambda s, d: performance.cache_efficiency(lab(s, d).read("query_history"), ASOF_EVENTS))

check(
    "repeated_patterns",
    f"""
    SELECT query_parameterized_hash, COUNT(*) AS execution_count, COUNT(DISTINCT user_name) AS unique_users,
        {r('AVG(total_elapsed_time) / 1000')} AS avg_duration_sec, {r('SUM(total_elapsed_time) / 1000 / 60')} AS total_duration_min,
        {r(f'AVG(bytes_scanned) / {GB}')} AS avg_gb_scanned, {r(f'SUM(bytes_scanned) / {TB}')} AS total_tb_scanned,
        {r('SUM(credits_used_cloud_services)')} AS total_cloud_credits,
        {r('AVG(partitions_scanned * 100.0::DOUBLE / NULLIF(partitions_total, 0))')} AS avg_partition_scan_pct, MAX(query_text) AS sample_query
    FROM query_history WHERE start_time >= {days(E, 30)} AND execution_status = 'SUCCESS' GROUP BY 1 HAVING COUNT(*) >= 10
    ORDER BY SUM(bytes_scanned) DESC, query_parameterized_hash LIMIT 20""",
)(lambda s, d: performance.repeated_patterns(lab(s, d).read("query_history"), ASOF_EVENTS))

# One row for each alert of a query, then one column for each kind of alert.
_ALERTS = " UNION ALL ".join(
    f"SELECT query_id, '{kind}' AS kind, '{label}' AS label, {weight} AS weight FROM recent WHERE {when}"
    for kind, label, weight, when in (
        ("long", performance.LONG_ALERT, 1, "total_elapsed_time > 300000"),
        ("scan", performance.SCAN_ALERT, 1, f"{_SCAN} > 0.9"),
        ("spill", performance.REMOTE_ALERT, 1, "bytes_spilled_to_remote_storage > 0"),
        ("spill", performance.LOCAL_ALERT, 0, "bytes_spilled_to_local_storage > 1073741824"),
        ("queue", performance.QUEUE_ALERT, 1, "queued_overload_time > 30000"),
        ("cache", performance.CACHE_ALERT, 0, "percentage_scanned_from_cache < 0.1 AND bytes_scanned > 1073741824"),
    )
)
check(
    "alert_dashboard",
    f"""
    WITH recent AS (SELECT * FROM query_history WHERE start_time >= {days(E, 1)}),
    alerts AS ({_ALERTS}),
    wide AS (SELECT query_id, MAX(label) FILTER (kind = 'long') AS long_running_alert, MAX(label) FILTER (kind = 'scan') AS partition_alert,
            ARG_MAX(label, weight) FILTER (kind = 'spill') AS spill_alert, MAX(label) FILTER (kind = 'queue') AS queue_alert,
            MAX(label) FILTER (kind = 'cache') AS cache_alert, SUM(weight) AS reasons FROM alerts GROUP BY query_id)
    SELECT query_id, user_name, warehouse_name, start_time, {r('total_elapsed_time / 1000 / 60')} AS duration_min, long_running_alert, partition_alert,
        spill_alert, queue_alert, cache_alert
    FROM recent JOIN wide USING (query_id) WHERE reasons > 0""",
)(lambda s, d: performance.alert_dashboard(lab(s, d).read("query_history"), ASOF_EVENTS))

check(
    "top_query_users",
    f"""
    SELECT user_name, COUNT(*) AS query_count, {r('SUM(total_elapsed_time) / 1000 / 60')} AS total_minutes
    FROM query_history GROUP BY 1 ORDER BY query_count DESC, user_name LIMIT 20""",
)(lambda s, d: performance.top_query_users(lab(s, d).read("query_history")))

check(
    "query_type_dist",
    f"""
    SELECT query_type, COUNT(*) AS query_count, {r('AVG(total_elapsed_time) / 1000')} AS avg_seconds
    FROM query_history GROUP BY 1 ORDER BY query_count DESC, query_type LIMIT 20""",
)(lambda s, d: performance.query_type_distribution(lab(s, d).read("query_history")))

# ---- storage --------------------------------------------------------------

check(
    "storage_growth_30d",
    f"""
    WITH d AS (SELECT usage_date, SUM(average_stage_bytes) / {TB} AS stage_tb, SUM(average_database_bytes) / {TB} AS database_tb,
            SUM(average_failsafe_bytes) / {TB} AS failsafe_tb,
            SUM(average_stage_bytes + average_database_bytes + average_failsafe_bytes) / {TB} AS total_tb
        FROM database_storage GROUP BY usage_date),
    p AS (SELECT *, LAG(total_tb, 30) OVER (ORDER BY usage_date) AS b FROM d)
    SELECT usage_date, {r('stage_tb')} AS stage_tb, {r('database_tb')} AS database_tb, {r('failsafe_tb')} AS failsafe_tb,
        {r('total_tb')} AS total_tb, {r('(total_tb - b) / NULLIF(b, 0) * 100')} AS monthly_growth_pct FROM p""",
)(lambda s, d: storage.storage_growth(lab(s, d).read("database_storage")))

check(
    "storage_inventory",
    f"""
    SELECT CAST(date_trunc('month', usage_date) AS DATE) AS month, {r(f'SUM(average_database_bytes) / {TB}')} AS database_tb,
        {r(f'SUM(average_stage_bytes) / {TB}')} AS stage_tb, {r(f'SUM(average_failsafe_bytes) / {TB}')} AS failsafe_tb,
        {r(f'SUM(average_database_bytes + average_stage_bytes + average_failsafe_bytes) / {TB}')} AS total_tb
    FROM database_storage GROUP BY 1""",
)(lambda s, d: storage.storage_inventory(lab(s, d).read("database_storage")))

_NAMES = "table_catalog AS database_name, table_schema AS schema_name, table_name"
_CHURN_PCT = f"{r('failsafe_bytes * 100.0::DOUBLE / NULLIF(active_bytes, 0)', 2)} AS churn_pct"
_CHURN = """CASE WHEN failsafe_bytes > active_bytes * 0.5 THEN '{}' WHEN failsafe_bytes > active_bytes * 0.1 THEN 'MEDIUM CHURN'
        ELSE 'LOW CHURN' END"""
check(
    "hot_tables",
    f"""
    SELECT {_NAMES}, {r(f'active_bytes / {GB}')} AS active_gb, {r(f'time_travel_bytes / {GB}')} AS time_travel_gb,
        {r(f'failsafe_bytes / {GB}')} AS failsafe_gb, {_CHURN_PCT}, {_CHURN.format('HIGH CHURN')} AS churn_category
    FROM table_storage WHERE active_bytes > 0 ORDER BY failsafe_bytes DESC, id LIMIT 50""",
)(lambda s, d: storage.hot_tables(lab(s, d).read("table_storage")))

check(
    "hot_tables_dr",
    f"""
    SELECT {_NAMES}, {r(f'active_bytes / {GB}', 2)} AS active_gb, {r(f'failsafe_bytes / {GB}', 2)} AS failsafe_gb, {_CHURN_PCT},
        {_CHURN.format('HIGH CHURN - Priority DR')} AS dr_priority
    FROM table_storage WHERE active_bytes > 0 ORDER BY failsafe_bytes DESC, id LIMIT 30""",
)(lambda s, d: storage.hot_tables_dr(lab(s, d).read("table_storage")))

check(
    "largest_tables",
    f"""
    SELECT {_NAMES}, {r(f'active_bytes / {GB}', 2)} AS active_gb, {r(f'time_travel_bytes / {GB}', 2)} AS time_travel_gb,
        {r(f'failsafe_bytes / {GB}', 2)} AS failsafe_gb, {r(f'(active_bytes + time_travel_bytes + failsafe_bytes) / {GB}', 2)} AS total_gb
    FROM table_storage WHERE active_bytes > 0 ORDER BY active_bytes DESC, id LIMIT 25""",
)(lambda s, d: storage.largest_tables(lab(s, d).read("table_storage")))

check(
    "storage_by_db",
    f"""
    SELECT database_name, usage_date, {r(f'average_database_bytes / {GB}', 2)} AS database_gb, {r(f'average_failsafe_bytes / {GB}', 2)} AS failsafe_gb
    FROM database_storage WHERE usage_date >= {days(O, 90)}""",
)(lambda s, d: storage.storage_by_database(lab(s, d).read("database_storage"), ASOF_ORDERS))

# ---- tasks ----------------------------------------------------------------

check(
    "task_failures",
    f"""
    SELECT name AS task_name, database_name, schema_name, state, COUNT(*) AS run_count,
        CAST(SUM(CASE WHEN state = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failure_count,
        {r("SUM(CASE WHEN state = 'FAILED' THEN 1 ELSE 0 END) * 100.0::DOUBLE / COUNT(*)", 2)} AS failure_pct, MAX(error_message) AS latest_error
    FROM task_history WHERE scheduled_time >= {days(O, 7)} GROUP BY 1, 2, 3, 4 HAVING SUM(CASE WHEN state = 'FAILED' THEN 1 ELSE 0 END) > 0""",
)(lambda s, d: tasks.task_failures(lab(s, d).read("task_history"), ASOF_ORDERS))

check(
    "task_timeline",
    f"""
    SELECT name AS task_name, state, scheduled_time, query_start_time, completed_time,
        date_diff('second', query_start_time, completed_time) AS duration_seconds, attempt_number, error_message
    FROM task_history WHERE scheduled_time >= {O} - INTERVAL 24 HOUR""",
)(lambda s, d: tasks.task_timeline(lab(s, d).read("task_history"), ASOF_ORDERS))

check(
    "task_history_recent",
    f"""
    SELECT name, state, scheduled_time, completed_time, error_message FROM task_history
    WHERE scheduled_time >= {days(O, 7)} ORDER BY scheduled_time DESC, run_id LIMIT 20""",
)(lambda s, d: tasks.task_history_recent(lab(s, d).read("task_history"), ASOF_ORDERS))

check(
    "latest_task_run",
    """
    SELECT name, scheduled_time, run_id, state, completed_time, error_message FROM task_history
    QUALIFY ROW_NUMBER() OVER (PARTITION BY name ORDER BY scheduled_time DESC NULLS LAST, run_id DESC) = 1""",
)(lambda s, d: tasks.latest_task_run(lab(s, d).read("task_history")))

check(
    "replication_rpo",
    f"""
    SELECT database_name, start_time, end_time, date_diff('minute', start_time, end_time) AS replication_minutes,
        {r('credits_used', 4)} AS credits, {r(f'bytes_transferred / {GB}', 2)} AS gb_transferred
    FROM replication_usage WHERE start_time >= {days(O, 7)}""",
)(lambda s, d: tasks.replication_rpo(lab(s, d).read("replication_usage"), ASOF_ORDERS))


# ---- rollups that follow the loads ------------------------------------------

FROM, TO = "1996-03-10", "1999-11-05"
check(
    "rollup_daily_credits",
    f"""
    SELECT date_trunc('day', start_time)::TIMESTAMP AS period, warehouse_name, COUNT(*) AS row_count, {r('SUM(credits_used)')} AS daily_credits
    FROM {METERING_LAST} GROUP BY 1, 2""",
)(lambda s, d: lab(s, d).rollup(DAILY_CREDITS).sums().withColumn("daily_credits", F.col("daily_credits").cast("double")))

check(
    "rollup_credits_in_range",
    f"""
    SELECT warehouse_name, COUNT(*) AS row_count, {r('SUM(credits_used)')} AS daily_credits FROM {METERING_LAST}
    WHERE start_time >= TIMESTAMP '{FROM}' AND start_time < TIMESTAMP '{TO}' GROUP BY 1""",
)(
    lambda s, d: lab(s, d)
    .rollup(DAILY_CREDITS)
    .sums(FROM, TO, by=["warehouse_name"])
    .withColumn("daily_credits", F.col("daily_credits").cast("double"))
)

check(
    "rollup_distinct_objects",
    f"""
    SELECT warehouse_name, COUNT(DISTINCT object_id) AS objects FROM {METERING_LAST}
    WHERE start_time >= TIMESTAMP '1996-03-01' AND start_time < TIMESTAMP '1999-11-01' GROUP BY 1""",
)(lambda s, d: lab(s, d).rollup(MONTHLY_CHARGES).distinct("objects", "1996-03-01", "1999-11-01", by=["warehouse_name"]))

check(
    "rollup_distinct_users",
    """SELECT COUNT(DISTINCT user_name) AS users FROM query_history
       WHERE start_time >= TIMESTAMP '2024-01-04 07:00' AND start_time < TIMESTAMP '2024-01-27 13:00'""",
)(lambda s, d: lab(s, d).rollup(HOURLY_QUERIES).distinct("users", "2024-01-04 07:00", "2024-01-27 13:00"))


def _rank_check(name: str, rollup, measure: str, column: str, table: str, share: float) -> None:
    """Sketches promise a rank, not a value: the rank of the answer among the rows has to lie within the promised error."""
    rows = f"SELECT warehouse_name, COUNT({column}) AS row_count, TRUE AS within FROM {table} GROUP BY 1"

    def query(spark, sf_dir):
        store = lab(spark, sf_dir).rollup(rollup)
        answers = store.quantile(measure, share, by=["warehouse_name"])
        open_rows = store.archive.read("open").select("warehouse_name", F.col(column).cast("double").alias("v"))
        ranks = open_rows.join(answers, "warehouse_name").groupBy("warehouse_name", "row_count").agg(
            F.avg((F.col("v") < F.col(measure)).cast("double")).alias("below"), F.avg((F.col("v") <= F.col(measure)).cast("double")).alias("upto")
        )
        within = (F.col("below") <= share + RANK_ERROR) & (F.col("upto") >= share - RANK_ERROR)
        return ranks.select("warehouse_name", "row_count", within.alias("within"))

    check(name, rows)(query)


_rank_check("rollup_p95_elapsed", HOURLY_QUERIES, "elapsed", "total_elapsed_time", "query_history", 0.95)
_rank_check("rollup_median_credits", MONTHLY_CHARGES, "credits", "credits_used", METERING_LAST, 0.5)


# ---- most frequent values from daily summaries -------------------------------

for _name, _column in {"top_users_by_day_summaries": "user_name", "top_patterns_by_day_summaries": "query_parameterized_hash"}.items():
    check(
        _name,
        f"""
        SELECT {_column} AS value, COUNT(*) AS row_count FROM query_history
        WHERE start_time >= TIMESTAMP '2024-01-04' AND start_time < TIMESTAMP '2024-01-27' AND {_column} IS NOT NULL
        GROUP BY 1 ORDER BY row_count DESC, value LIMIT 20""",
    )(lambda s, d, column=_column: lab(s, d).frequent(column).top(20, "2024-01-04", "2024-01-27"))
