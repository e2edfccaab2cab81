"""Logins, brute force, MFA, dormancy and administrators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearring.functions.measures import count_if
from yearring.functions.timefn import days_before, days_between, minute_number, minutes_between, trunc_ts, ts
from yearring.operators.temporal import current_state

_DAY_MINUTES = 1440


def login_patterns(logins: DataFrame, asof: str, dormant_days: int = 90) -> DataFrame:
    stale = ts(asof) - F.make_dt_interval(F.lit(dormant_days))
    return (
        current_state(logins)
        .filter(F.col("is_success") == "YES")
        .groupBy(
            "user_name", "client_ip", "reported_client_type", trunc_ts("month", "event_timestamp").alias("month")
        )
        .agg(
            F.count("*").alias("login_count"),
            F.countDistinct(F.col("event_timestamp").cast("date")).alias("active_days"),
            F.min("event_timestamp").alias("first_login"),
            F.max("event_timestamp").alias("last_login"),
        )
        .withColumn(
            "account_status",
            F.when(F.col("last_login") < stale, "DORMANT - Review for deactivation").otherwise("ACTIVE"),
        )
        .orderBy(F.desc("month"), F.desc("login_count"), "user_name", "client_ip", "reported_client_type")
    )


def failed_logins_24h(logins: DataFrame) -> DataFrame:
    """Each failed login with the user's failures in the 24 hours up to it.

    A window per user would sort one attacked account in one task.  Here the
    count is put together from three exact pieces, keyed by (user, minute):

    * rows of the same minute up to this one,
    * whole minutes in between, from counts per (user, minute),
    * rows of the minute 24 hours ago that still fall inside, found by moving a
      copy of every row 24 hours forward.
    """
    # One text key per user, also for the NULL user, so that both sides of the
    # join at the end are partitioned alike and the rows move only once.
    key = ["_user", "_minute"]
    failed = (
        current_state(logins)
        .filter(F.col("is_success") == "NO")
        .select(
            "event_id",
            "event_timestamp",
            "user_name",
            "client_ip",
            "reported_client_type",
            "error_code",
            "error_message",
            "first_authentication_factor",
            "second_authentication_factor",
            minute_number(F.col("event_timestamp")).alias("_minute"),
            F.coalesce(F.concat(F.lit("u"), "user_name"), F.lit("n")).alias("_user"),
        )
    )
    own = failed.withColumns({"_at": F.col("event_timestamp"), "_own": F.lit(1)})
    moved = (
        failed.filter(F.col("event_timestamp").isNotNull())
        .select("_user", F.col("event_timestamp") + F.make_dt_interval(F.lit(1)), F.col("_minute") + _DAY_MINUTES)
        .toDF("_user", "_at", "_minute")
        .withColumn("_own", F.lit(0))
    )
    minute = Window.partitionBy(*key).orderBy("_at")
    edges = (
        own.unionByName(moved, allowMissingColumns=True)
        .withColumns(
            {
                "_now": F.sum("_own").over(minute.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
                "_then": F.sum(1 - F.col("_own")).over(
                    minute.rangeBetween(Window.currentRow, Window.unboundedFollowing)
                ),
            }
        )
        .filter("_own = 1")
    )
    between = Window.partitionBy("_user").orderBy("_minute").rangeBetween(1 - _DAY_MINUTES, -1)
    whole = (
        failed.filter(F.col("_minute").isNotNull())
        .groupBy(*key)
        .agg(F.count("*").alias("_n"))
        .select(*key, F.sum("_n").over(between).alias("_mid"))
    )
    return (
        edges.join(whole, key, "left")
        .withColumn("failed_attempts_24h", F.col("_now") + F.col("_then") + F.coalesce("_mid", F.lit(0)))
        .drop(*key, "_at", "_own", "_now", "_then", "_mid")
        .orderBy(F.desc("event_timestamp"), "event_id")
    )


def brute_force(logins: DataFrame, asof: str, days: int = 7, least: int = 5) -> DataFrame:
    return (
        current_state(logins)
        .filter((F.col("is_success") == "NO") & (F.col("event_timestamp") >= days_before(asof, days)))
        .groupBy("client_ip", "user_name", "reported_client_type")
        .agg(
            F.count("*").alias("failed_attempts"),
            F.min("event_timestamp").alias("first_attempt"),
            F.max("event_timestamp").alias("last_attempt"),
        )
        .filter(F.col("failed_attempts") >= least)
        .withColumn("window_minutes", minutes_between("first_attempt", "last_attempt"))
        .orderBy(F.desc("failed_attempts"), "client_ip", "user_name", "reported_client_type")
    )


def failed_login_summary(logins: DataFrame, asof: str, days: int = 7, limit: int = 20) -> DataFrame:
    keys = ["user_name", "client_ip", "reported_client_type", "error_code", "error_message"]
    return (
        current_state(logins)
        .filter((F.col("is_success") == "NO") & (F.col("event_timestamp") >= days_before(asof, days)))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("failure_count"),
            F.min("event_timestamp").alias("first_failure"),
            F.max("event_timestamp").alias("last_failure"),
        )
        .orderBy(F.desc("failure_count"), *keys)
        .limit(limit)
    )


def failed_login_list(logins: DataFrame, limit: int = 100) -> DataFrame:
    return (
        current_state(logins)
        .filter(F.col("is_success") == "NO")
        .orderBy(F.desc_nulls_last("event_timestamp"), "event_id")
        .limit(limit)
        .select("user_name", "client_ip", "error_code", "error_message", "event_timestamp")
    )


def login_by_user(logins: DataFrame, limit: int = 50) -> DataFrame:
    return (
        current_state(logins)
        .groupBy("user_name")
        .agg(
            F.count("*").alias("login_count"),
            count_if(F.col("is_success") == "YES").alias("success_count"),
            count_if(F.col("is_success") == "NO").alias("failure_count"),
        )
        .orderBy(F.desc("login_count"), "user_name")
        .limit(limit)
    )


def mfa_missing(users: DataFrame, asof: str, limit: int | None = None) -> DataFrame:
    """Enabled users whose MFA flag is false or unknown; the dashboard form has a limit."""
    report = (
        current_state(users)
        .filter((~F.col("has_mfa") | F.col("has_mfa").isNull()) & (F.col("disabled") == "false"))
        .select(
            F.col("name").alias("user_name"),
            "email",
            "default_role",
            "has_mfa",
            "last_success_login",
            "disabled",
            days_between("last_success_login", ts(asof)).alias("days_since_login"),
        )
        .orderBy(F.desc_nulls_last("last_success_login"), "user_name")
    )
    return report if limit is None else report.limit(limit)


def dormant_users(users: DataFrame, asof: str, days: int = 90) -> DataFrame:
    stale = ts(asof) - F.make_dt_interval(F.lit(days))
    return (
        current_state(users)
        .filter((F.col("disabled") == "false") & (F.col("last_success_login") < stale))
        .select(
            F.col("name").alias("user_name"),
            "email",
            "default_role",
            "last_success_login",
            days_between("last_success_login", ts(asof)).alias("days_inactive"),
            "disabled",
            "has_mfa",
        )
        .orderBy(F.desc("days_inactive"), "user_name")
    )


def admins(grants: DataFrame, users: DataFrame, role: str) -> DataFrame:
    """Holders of one role with their current user record, if any."""
    g = current_state(grants).filter(F.col("role") == role).alias("g")
    u = current_state(users).alias("u")
    return (
        g.join(u, F.col("g.grantee_name") == F.col("u.name"), "left")
        .select(
            F.col("g.grantee_name").alias("user_name"),
            F.col("g.role").alias("granted_role"),
            "g.granted_by",
            F.col("g.created_on").alias("grant_date"),
            "u.email",
            "u.has_mfa",
            "u.last_success_login",
            "u.disabled",
        )
        .orderBy("grant_date", "user_name")
    )
