"""Row fingerprints used for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed text forms, so that a hash does not depend on session settings and
# changes below one millisecond are seen.
_JSON = {
    "ignoreNullFields": "true",
    "timeZone": "UTC",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _varies(kind: T.DataType) -> bool:
    """Whether equal values of the type may have different texts, now or after the type has grown."""
    if isinstance(kind, T.ArrayType):
        return _varies(kind.elementType)
    if isinstance(kind, T.StructType):
        return True
    return isinstance(kind, (T.MapType, T.DecimalType, T.FloatType, T.DateType))


def _canonical(col: Column, kind: T.DataType) -> Column:
    """One form for equal values at any depth.

    Map entries and struct fields in name order, and values as they would be in a wider type: a decimal without trailing zeros,
    a float as the double it equals, a date as its first moment.
    """
    if not _varies(kind):
        return col
    if isinstance(kind, T.DecimalType):
        text = col.cast("string")
        return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    if isinstance(kind, T.FloatType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return col.cast("timestamp_ntz")
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(col), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        return F.transform(
            entries,
            lambda e: F.struct(e["key"].alias("key"), _canonical(e["value"], kind.valueType).alias("value")),
        )
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda e: _canonical(e, kind.elementType))
    fields = [_canonical(col[f.name], f.dataType).alias(f.name.lower()) for f in sorted(kind.fields, key=lambda f: f.name.lower())]
    return F.when(col.isNotNull(), F.struct(*fields))


def row_hash(schema: T.StructType, exclude: Sequence[str] = ()) -> Column:
    """SHA-256 of the row as JSON, with columns in name order and NULLs left out.

    Leaving NULLs out keeps old hashes valid when a new column arrives empty.
    """
    fields = sorted((f for f in schema.fields if f.name not in exclude), key=lambda f: f.name.lower())
    parts = [_canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name.lower()) for f in fields]
    return F.sha2(F.to_json(F.struct(*parts), _JSON), 256)


def row_hash_concat(columns: Sequence[str], sep: str = "|") -> Column:
    """SHA-256 of the joined column texts, in the order given.

    ``concat_ws`` skips NULLs, so (NULL, 'a') and ('a', NULL) collide; the loads
    use :func:`row_hash`.
    """
    return F.sha2(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]), 256)


def hash_key(col: str = "_row_hash") -> Column:
    """The hash as 32 raw bytes: half the shuffle volume of its hex text."""
    return F.unhex(F.col(col))
