"""Versions of records by their key, through Bloom filters of the stored row groups.

An archive whose loads name a key carries a Bloom filter on it in each row group.  A few keys reach the scan as equalities, so row groups
without them are not decoded; many keys are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.sources.store import Archive

#: Keys that are pushed to the scan, each as an equality: a longer IN list would reach it as a range only.
PUSHED = 100


def key_lookup(archive: Archive, keys: Sequence[Any] | DataFrame, state: str | None = None) -> DataFrame:
    """All versions, or those of one state, whose registered key is among ``keys``: values, or the first column of a DataFrame.

    NULL keys match nothing, repeated ones match once.  At most ``PUSHED + 1`` keys of a DataFrame come to the driver; if there are more,
    they stay where they are and a semi join finds the rows, whose sides Spark broadcasts only by their measured size.
    """
    manifest = archive.manifest()
    if manifest is None:
        raise FileNotFoundError(f"no archive at {archive.path}")
    if manifest.key is None:
        raise ValueError(f"no load of {archive.path} named a key")
    rows, kind = archive.read(state, manifest), manifest.struct[manifest.key].dataType
    if isinstance(keys, DataFrame):
        wanted = keys.select(keys[keys.columns[0]].cast(kind).alias("_key")).filter("_key IS NOT NULL").distinct()
        few = wanted.limit(PUSHED + 1).collect()
        if len(few) > PUSHED:
            return rows.join(wanted, rows[manifest.key] == wanted["_key"], "left_semi")
        keys = [r["_key"] for r in few]
    elif len(keys) > PUSHED:
        spark = archive.spark
        return key_lookup(archive, spark.createDataFrame([(k,) for k in keys]), state)
    tests = [F.col(f"`{manifest.key}`") == F.lit(k).cast(kind) for k in keys if k is not None]
    return rows.filter(reduce(or_, tests, F.lit(False)))
