"""Reading history: now, as of a time, over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearring.functions.hashing import row_hash
from yearring.functions.timefn import days_between, ts
from yearring.operators.scd import HISTORY_COLUMNS, OPEN_END


def current_state(archive: DataFrame) -> DataFrame:
    return archive.filter("_is_current")


def as_of(archive: DataFrame, when: str) -> DataFrame:
    """Versions in force at ``when``; an open end may be the far date or NULL."""
    at = ts(when)
    return archive.filter(
        (F.col("_valid_from") <= at) & ((F.col("_valid_to") > at) | F.col("_valid_to").isNull())
    )


def record_history(archive: DataFrame, key: Column, newest_first: bool = True) -> DataFrame:
    """All versions of the records selected by ``key``."""
    order = F.desc_nulls_last if newest_first else F.asc_nulls_last
    return archive.filter(key).orderBy(order("_valid_from"), order("_archive_id"))


def changes_between(archive: DataFrame, start: str, end: str) -> DataFrame:
    """Versions opened from start to end, both included."""
    return archive.filter(F.col("_valid_from").between(ts(start), ts(end))).orderBy("_valid_from", "_archive_id")


def change_counts(archive: DataFrame, since: str) -> DataFrame:
    counted = archive.filter(F.col("_valid_from") >= ts(since)).groupBy("_source_table")
    return (
        counted.agg(F.count("*").alias("changes"))
        .select(F.col("_source_table").alias("table_name"), "changes")
        .orderBy(F.desc("changes"), "table_name")
    )


def deleted_records(closed: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Closed versions whose key has no current version.

    The current side shrinks to its distinct keys first; a hot key on the closed
    side is the left side of the anti join, which AQE can split.
    """
    ended = closed.filter((~F.col("_is_current")) & (F.col("_valid_to") != ts(OPEN_END)))
    return ended.join(current.filter("_is_current").select(*keys).distinct(), keys, "left_anti")


def validity_days(asof: str) -> Column:
    """Days a version has been in force, up to ``asof`` while it is current."""
    end = F.when(F.col("_is_current"), ts(asof)).otherwise(F.col("_valid_to"))
    return days_between("_valid_from", end)


def duplicate_current(archive: DataFrame) -> DataFrame:
    """Source tables with identical current rows.

    Counts per (table, hash) come first, so copies collapse before the shuffle.
    """
    per_hash = archive.filter("_is_current").groupBy("_source_table", "_row_hash").agg(F.count("*").alias("n"))
    return (
        per_hash.groupBy("_source_table")
        .agg(F.sum("n").alias("dupes"), F.count("_row_hash").alias("hashes"))
        .filter("dupes <> hashes")
        .select("_source_table", "dupes")
    )


def verify_hash(archive: DataFrame) -> DataFrame:
    """Recompute every stored hash and count the rows that no longer match."""
    again = row_hash(archive.schema, HISTORY_COLUMNS)
    wrong = F.when(again == F.col("_row_hash"), 0).otherwise(1)
    return archive.groupBy("_source_table").agg(
        F.count("*").alias("versions"), F.sum(wrong).alias("mismatches")
    )
