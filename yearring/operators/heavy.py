"""The most frequent values of a column over a range of days, exactly, without grouping all values.

A table beside the archive keeps one frequent-items summary per day.  Summaries of the days asked for are combined into candidates, at most
``TRACKED`` values, whose rows are then counted in one narrow pass: the candidates are broadcast, so the long tail of other values is dropped
before the shuffle.

Of N rows, a value that is no candidate has at most ``2 * 3.5 / slots * N`` of them, and at most as many as the candidates leave over.  If
the last value of the answer is above that bound, no other value can be in the answer; if it isn't, because the values are about
equally frequent, all are grouped.  Either way the answer is exact.

NULL is not ranked, ties go to the smaller value.  Rows loaded after the last refresh are counted only after the next one.  Versions that
ended can't be taken out of a summary, so the archive must be one that only grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.functions.timefn import ts
from yearring.operators.sidetable import SideTable
from yearring.sources.store import OPEN, Archive

TRACKED = 10_000


def bound(rows: int, counted: int, tracked: int = TRACKED) -> int:
    """Most rows that a value outside the candidates can have."""
    slots = 1
    while slots * 0.75 < tracked:
        slots *= 2
    return min(int(2 * 3.5 / slots * rows), rows - counted)


class HeavyHitters(SideTable):
    """Summaries of ``column`` by the day of ``time``."""

    def __init__(self, archive: Archive, column: str, time: str, tracked: int = TRACKED):
        super().__init__(archive, f"frequent-{column}-{tracked}")
        self.column, self.time, self.tracked = column, time, tracked

    def build(self, versions: DataFrame) -> DataFrame:
        if self.archive.manifest().ends():
            raise ValueError("summaries need an archive whose versions don't end")
        rows = versions.filter(F.col(self.column).isNotNull()).groupBy(F.to_date(self.time).alias("day"))
        return rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(`{self.column}`, {self.tracked})").alias("summary")).coalesce(1)

    def _days(self, start: str, end: str) -> DataFrame:
        stored = self.read()
        if stored is None:
            raise ValueError("no summaries are stored yet: refresh first")
        return stored.filter((F.col("day") >= F.lit(start).cast("date")) & (F.col("day") < F.lit(end).cast("date")))

    def candidates(self, start: str, end: str) -> DataFrame:
        """``value``: at most ``tracked`` of them."""
        # grouped by a constant: without a key, Spark 4.1 can't combine summaries where a partition has none
        whole = self._days(start, end).groupBy(F.lit(1).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {self.tracked})").alias("s"))
        items = F.expr(f"approx_top_k_estimate(s, {self.tracked})")
        return whole.select(F.explode(items).alias("i")).select(F.col("i.item").alias("value"))

    def rows(self, start: str, end: str) -> DataFrame:
        """What the summaries of these days stand for."""
        day = (F.col(self.time) >= ts(f"{start} 00:00:00")) & (F.col(self.time) < ts(f"{end} 00:00:00"))
        stored = self.archive.read(OPEN).filter(day & (F.col("_archive_id") <= self.covered()) & F.col(self.column).isNotNull())
        return stored.select(F.col(self.column).alias("value"))

    def top(self, limit: int, start: str, end: str) -> DataFrame:
        """``value, row_count`` of the most frequent values from day ``start`` up to, not including, day ``end``."""
        rows = self.rows(start, end)
        total = self._days(start, end).agg(F.sum("n")).first()[0] or 0
        counted = rows.join(F.broadcast(self.candidates(start, end)), "value", "left_semi").groupBy("value").agg(F.count("*").alias("row_count"))
        found = [(r.value, r.row_count) for r in counted.collect()]  # at most ``tracked`` rows
        found.sort(key=lambda f: -f[1])
        outside = bound(total, sum(n for _, n in found), self.tracked)
        if outside and (len(found) < limit or found[limit - 1][1] <= outside):
            counted = rows.groupBy("value").agg(F.count("*").alias("row_count"))
        else:
            counted = self.archive.spark.createDataFrame(found, counted.schema)
        return counted.orderBy(F.desc("row_count"), "value").limit(limit)
