"""Evidence, data access and change trails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.functions.measures import gb
from yearring.functions.timefn import ts
from yearring.operators.temporal import current_state, record_history, validity_days


def privilege_evolution(grants: DataFrame, grantee: str, asof: str) -> DataFrame:
    """Every version of one grantee's grants, with the days each was in force."""
    return record_history(grants, F.col("grantee_name") == grantee).select(
        "grantee_name",
        "role",
        "granted_by",
        F.col("_valid_from").alias("privilege_granted_at"),
        F.col("_valid_to").alias("privilege_revoked_at"),
        F.col("_is_current").alias("currently_active"),
        validity_days(asof).alias("days_with_privilege"),
    )


def compliance_evidence(queries: DataFrame, databases: Sequence[str], asof: str, years: int = 7) -> DataFrame:
    since = ts(asof) - F.make_ym_interval(F.lit(years))
    return (
        current_state(queries)
        .filter(F.col("database_name").isin(*databases) & (F.col("start_time") >= since))
        .orderBy(F.desc("start_time"), "query_id")
        .select(
            F.lit("DATA_ACCESS_AUDIT").alias("report_type"),
            "user_name",
            "role_name",
            F.concat("database_name", F.lit("."), "schema_name").alias("data_location"),
            "query_type",
            F.col("start_time").alias("access_timestamp"),
            "execution_status",
            F.col("rows_produced").alias("records_accessed"),
            F.col("_loaded_at").alias("archived_at"),
            F.col("_row_hash").alias("integrity_hash"),
            F.col("_source_system").alias("source"),
        )
    )


def data_access(queries: DataFrame, pattern: str, start: str, end: str) -> DataFrame:
    """Queries whose text matches, ignoring case, in a closed time range."""
    return (
        current_state(queries)
        .filter(F.col("query_text").ilike(pattern) & F.col("start_time").between(ts(start), ts(end)))
        .orderBy(F.desc("start_time"), "query_id")
        .select(
            "user_name",
            "role_name",
            "query_text",
            "database_name",
            "schema_name",
            "start_time",
            "rows_produced",
            gb("bytes_scanned").alias("gb_scanned"),
        )
    )


def change_audit(databases: DataFrame, name: str) -> DataFrame:
    return record_history(databases, F.col("database_name") == name).select(
        "database_name",
        "database_owner",
        F.col("created").alias("originally_created"),
        F.col("_valid_from").alias("this_version_from"),
        F.col("_valid_to").alias("this_version_to"),
        F.col("_is_current").alias("is_current_state"),
        "comment",
        "options",
    )
