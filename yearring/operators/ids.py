"""Dense surrogate ids without a global sort.

One narrow job counts the rows of each partition, the driver turns the counts
into offsets (one number per partition), and the write job adds the offset to
the position inside the partition.  Both jobs must see the same partitions, so
the input has to be a plain scan of files, or be staged as one; a check in the write job fails the load otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from yearring.sources.store import COMPRESSION

_POSITION_BITS = (1 << 33) - 1
# One small row per partition; beyond this the offsets are joined without a hint.
_BROADCAST_PARTITIONS = 1_000_000


@dataclass(frozen=True)
class Written:
    rows: int
    mark: str | None = None


def write_numbered(
    df: DataFrame,
    path: str,
    id_column: str,
    base: int,
    mark: Column | None = None,
    mark_text: Callable[[Column], Column] | None = None,
    options: dict[str, str] | None = None,
) -> Written:
    """Write ``df`` with ids base+1 .. base+n in front; nothing is written for no rows.

    The overall maximum of ``mark`` is taken in the counting job, to save a
    pass, and comes back in the text form that ``mark_text`` gives it.  ``options`` go to the Parquet writer.
    """
    spark = df.sparkSession
    marks = [] if mark is None else [F.max("_mark").alias("_mark"), mark_text(F.max("_mark")).alias("_text")]
    counted = (
        df.select(F.spark_partition_id().alias("_part"), *([] if mark is None else [mark.alias("_mark")]))
        .groupBy("_part")
        .agg(F.count("*").alias("_n"), *marks)
        .collect()
    )
    counted.sort(key=lambda r: r["_part"])
    total = sum(r["_n"] for r in counted)
    marked = [r for r in counted if marks and r["_mark"] is not None]
    highest = max(marked, key=lambda r: r["_mark"])["_text"] if marked else None
    if total == 0:
        return Written(0)

    ends = list(accumulate(r["_n"] for r in counted))
    offsets = spark.createDataFrame(
        [(r["_part"], base + end - r["_n"], r["_n"]) for r, end in zip(counted, ends)],
        "_part int, _offset bigint, _size bigint",
    )
    if len(counted) <= _BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    seen = Observation()
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
    numbered = (
        df.withColumns({"_part": F.spark_partition_id(), "_pos": position})
        .join(offsets, "_part", "left")
        .observe(
            seen,
            F.count("*").alias("rows"),
            F.max(F.coalesce(F.col("_pos") - F.col("_size"), F.lit(0))).alias("overrun"),
        )
        .select((F.col("_offset") + F.col("_pos") + 1).alias(id_column), *df.columns)
    )
    numbered.write.mode("overwrite").options(**COMPRESSION, **(options or {})).parquet(path)
    if seen.get["rows"] != total or seen.get["overrun"] >= 0:
        raise RuntimeError("the input changed between counting and writing; stage it first")
    return Written(total, highest)
