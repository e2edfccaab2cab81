"""Loading a source into its type 2 history.

Three strategies: APPEND_ONLY takes rows past the stored watermark;
SOFT_DELETE_MUTABLE and FULL_COMPARE close current rows whose hash left the
source and insert source rows whose hash is not current.

A load whose source is a plain scan of files (``plain=True``) reads it where it lies; any other source is staged first, since
another run of its plan may give other rows or another order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearring.functions.hashing import hash_key, row_hash
from yearring.functions.types import conform, evolve_schema
from yearring.operators.ids import write_numbered
from yearring.operators.sieve import sifted
from yearring.sources.store import COMPRESSION, ENDS, OPEN, Archive, Manifest, key_options

APPEND_ONLY = "APPEND_ONLY"
SOFT_DELETE_MUTABLE = "SOFT_DELETE_MUTABLE"
FULL_COMPARE = "FULL_COMPARE"

OPEN_END = "9999-12-31 23:59:59"
HISTORY_COLUMNS = (
    "_archive_id",
    "_row_hash",
    "_loaded_at",
    "_source_system",
    "_source_table",
    "_is_current",
    "_valid_from",
    "_valid_to",
)
# 32 bytes each: a million hashes stay well inside a broadcast.
BROADCAST_HASHES = 1_000_000


@dataclass(frozen=True)
class LoadResult:
    source: str
    target: str
    status: str
    action: str | None = None
    strategy: str | None = None
    rows_inserted: int = 0
    rows_updated: int = 0
    reason: str | None = None
    error: str | None = None
    timestamp: str | None = None


def with_hash(source: DataFrame) -> DataFrame:
    return source.withColumn("_row_hash", row_hash(source.schema, HISTORY_COLUMNS))


def as_versions(hashed: DataFrame, archive: Archive, system: str, now: str) -> DataFrame:
    """Open versions of ``hashed`` rows, history columns first (the id is added on write)."""
    source = [c for c in hashed.columns if c not in HISTORY_COLUMNS]
    stamp = F.lit(now).cast("timestamp_ntz")
    return hashed.select(
        F.col("_row_hash"),
        stamp.alias("_loaded_at"),
        F.lit(f"{system}_{archive.schema}").alias("_source_system"),
        F.lit(archive.view).alias("_source_table"),
        F.lit(True).alias("_is_current"),
        stamp.alias("_valid_from"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("_valid_to"),
        *[F.col(f"`{c}`") for c in source],
    )


def watermark_text(col: Column, kind: T.DataType) -> Column:
    """A watermark as text that does not depend on the session zone."""
    return (F.unix_micros(col) if isinstance(kind, T.TimestampType) else col).cast("string")


def watermark_literal(text: str, kind: T.DataType) -> Column:
    """The stored watermark in the column's own type, so that the filter reaches Parquet."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    return F.lit(text).cast(kind)


def later_mark(spark: SparkSession, one: str | None, two: str | None, kind: T.DataType) -> str | None:
    """The later of two stored watermarks."""
    if one is None or two is None:
        return one or two
    later = F.greatest(watermark_literal(one, kind), watermark_literal(two, kind))
    return spark.range(1).select(watermark_text(later, kind).alias("w")).first()["w"]


def mark_type(source: DataFrame, column: str | None) -> str | None:
    return source.schema[column].dataType.simpleString() if column and column in source.columns else None


def scan_delta(source: DataFrame, column: str, last: str, inclusive: bool = False) -> DataFrame:
    """Source rows past the watermark; rows with a NULL watermark never qualify."""
    mark = watermark_literal(last, source.schema[column].dataType)
    return source.filter(F.col(column) >= mark if inclusive else F.col(column) > mark)


def stage_source(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: one scan of the source, and lineage that survives lost executors."""
    df.write.mode("overwrite").options(**COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _mark(source: DataFrame, column: str | None) -> tuple:
    """The watermark column and its text form, if the source has one."""
    if column is None or column not in source.columns:
        return ()
    kind = source.schema[column].dataType
    return F.col(column), lambda highest: watermark_text(highest, kind)


def _insert(
    fresh: DataFrame, archive: Archive, struct: T.StructType, version: int, base: int, mark: tuple = (), key: str | None = None
):
    """Write new open versions as one part; returns the write and the parts to add."""
    directory = f"{archive.run_dir(version)}/{OPEN}"
    written = write_numbered(conform(fresh, struct), f"{archive.path}/{directory}", "_archive_id", base, *mark, options=key_options(key))
    parts = (archive.part(directory, OPEN, written.rows),) if written.rows else ()
    return written, parts


def _archive_struct(versions: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("_archive_id", T.LongType()), *[T.StructField(f.name, f.dataType) for f in versions.schema.fields]])


def load_initial(
    archive: Archive,
    source: DataFrame,
    now: str,
    system: str = "SOURCE",
    watermark_column: str | None = None,
    plain: bool = False,
    key: str | None = None,
) -> tuple[Manifest, int]:
    """First load: every row becomes a current version with ids 1..n."""
    hashed = with_hash(source)
    if not plain:
        hashed = stage_source(hashed, archive.staging_dir(1))
    versions = as_versions(hashed, archive, system, now)
    struct = _archive_struct(versions)
    written, parts = _insert(versions, archive, struct, 1, 0, _mark(source, watermark_column), key)
    manifest = archive.commit(
        Manifest(
            version=1,
            schema=struct.jsonValue(),
            parts=parts,
            max_id=written.rows,
            watermark=written.mark,
            watermark_type=mark_type(source, watermark_column),
            key=key,
            created=now,
            modified=now,
            rows_loaded=written.rows,
        )
    )
    return manifest, written.rows


def load_append_only(
    archive: Archive,
    source: DataFrame,
    now: str,
    watermark_column: str,
    system: str = "SOURCE",
    inclusive: bool = False,
    plain: bool = False,
    key: str | None = None,
) -> tuple[Manifest, int]:
    """Insert rows past the watermark; no row is ever closed.

    By default rows equal to the watermark, late rows and NULL watermarks stay
    out.  ``inclusive`` also takes rows equal to it that are not stored yet.
    """
    old = archive.manifest()
    version = old.version + 1
    delta = with_hash(scan_delta(source, watermark_column, old.watermark, inclusive))
    if inclusive:
        mark = watermark_literal(old.watermark, source.schema[watermark_column].dataType)
        stored = archive.read(OPEN, old).filter(F.col(watermark_column) >= mark).select("_row_hash").distinct()
        delta = delta.join(stored, "_row_hash", "left_anti")
    if inclusive or not plain:
        delta = stage_source(delta, archive.staging_dir(version))
    versions = as_versions(delta, archive, system, now)
    struct = evolve_schema(old.struct, versions.schema)
    written, parts = _insert(versions, archive, struct, version, old.max_id, _mark(source, watermark_column), key or old.key)
    manifest = archive.commit(
        replace(
            old,
            version=version,
            schema=struct.jsonValue(),
            parts=(*old.parts, *parts),
            max_id=old.max_id + written.rows,
            watermark=written.mark or old.watermark,
            watermark_type=mark_type(source, watermark_column),
            key=key or old.key,
            modified=now,
            rows_loaded=written.rows if written.mark else old.rows_loaded,
        )
    )
    return manifest, written.rows


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _probe(source: DataFrame) -> Column | None:
    """A cheap 64-bit hash of a row as it lies in the source: many times faster than the row hash, which reads the row as JSON."""
    columns = [F.col(f"`{f.name}`") for f in source.schema.fields if not _has_map(f.dataType)]
    return F.xxhash64(*columns) if columns else None


def hash_difference(
    source: DataFrame,
    versions: DataFrame,
    ends: DataFrame | None = None,
    mark: str | None = None,
    probe: Column | None = None,
) -> DataFrame:
    """Per hash: copies in the source, open copies in the archive, the id up to which earlier copies ended, the highest mark, and
    the lowest and highest probe.

    All but the hash are fixed-width numbers, so that rows are hashed and not sorted.

    Open copies are stored versions less what ends closed, so no join is needed: one aggregation over 32-byte keys with partial sums
    on the map side.  A row copied a billion times travels once per task, and neither wide side moves.
    """
    sides = [(source, F.lit(1), F.lit(0), F.lit(0)), (versions, F.lit(0), F.lit(1), F.lit(0))]
    if ends is not None:
        sides.append((ends, F.lit(0), -F.col("copies"), F.col("upto")))
    keys = []
    for side, here, there, upto in sides:
        key = F.col("h") if side is ends else hash_key()
        columns = [key.alias("h"), here.cast("long").alias("here"), there.cast("long").alias("there"), upto.cast("long").alias("after")]
        if mark:
            columns.append((F.col(mark) if side is source else F.lit(None).cast(source.schema[mark].dataType)).alias("mark"))
        if probe is not None:
            columns.append((probe if side is source else F.lit(None).cast("long")).alias("probe"))
        keys.append(side.select(*columns))
    sums = [F.sum("here").alias("here"), F.sum("there").alias("there"), F.max("after").alias("after")]
    if mark:
        sums.append(F.max("mark").alias("mark"))
    if probe is not None:
        sums += [F.min("probe").alias("probe"), F.max("probe").alias("other_probe")]
    return reduce(DataFrame.unionByName, keys).groupBy("h").agg(*sums)


def _new_rows(source: DataFrame, difference: DataFrame, count: int, probe: Column | None) -> DataFrame:
    """Source rows whose hash is new.

    Keys are broadcast only while their counted number is small; beyond that a bitmap of them is, and the few rows that it lets through
    are shuffled to the keys.  The probe comes first, so that few rows are hashed again.  Keys are never null; the null-safe
    comparison keeps the optimizer from hashing every row once more to see that.
    """
    keys, few = difference.filter(NEW), count <= BROADCAST_HASHES
    if probe is not None and few:
        probes = F.broadcast(keys.select(F.col("probe").alias("_probe")))
        source = source.join(probes, probe.eqNullSafe(probes["_probe"]), "left_semi")
    elif probe is not None:
        source = sifted(source, probe, keys, F.col("probe"), count)
    hashed = source if "_row_hash" in source.columns else with_hash(source)
    if probe is None and not few:
        hashed = sifted(hashed, F.xxhash64(hash_key()), keys, F.xxhash64("h"), count)
    if few:
        keys = F.broadcast(keys.select("h"))
        return hashed.join(keys, hash_key().eqNullSafe(keys["h"]), "left_semi")
    # As bytes, since the hex text would double what the join moves.
    found = hashed.withColumn("_row_hash", hash_key()).join(keys.select("h"), F.col("_row_hash").eqNullSafe(keys["h"]), "left_semi")
    return found.withColumn("_row_hash", F.lower(F.hex("_row_hash")))


def _carried(versions: DataFrame, gone: DataFrame, count: int, carry: tuple[str, ...]) -> DataFrame:
    """Rows of ``gone`` with the columns ``carry`` of the stored versions of their hash, which are the same in all of them."""
    columns = versions.select(hash_key().alias("h"), F.struct(*carry).alias("carried"))
    if count <= BROADCAST_HASHES:
        picked = columns.join(F.broadcast(gone.select("h")), "h", "left_semi")
    else:
        picked = sifted(columns, F.xxhash64("h"), gone, F.xxhash64("h"), count)
    return gone.join(picked.groupBy("h").agg(F.first("carried").alias("carried")), "h")


NEW, GONE = "here > 0 AND there = 0", "here = 0 AND there > 0"


def load_full(
    archive: Archive,
    source: DataFrame,
    now: str,
    system: str = "SOURCE",
    watermark_column: str | None = None,
    close: bool = True,
    plain: bool = False,
    carry: Sequence[str] = (),
    key: str | None = None,
) -> tuple[Manifest, int, int]:
    """Close what left the source and insert what is new, in one commit.

    With ``close=False`` nothing is closed: rows not stored yet are added.

    One pass over hashes finds the difference and the watermark; what ends is written as narrow rows, and only if there are new
    rows is the source read again, for those alone.  No stored row is rewritten, so the cost beyond that pass follows the change.
    ``carry`` names columns of the ended versions that their ends keep, for rollups.
    """
    old = archive.manifest()
    version = old.version + 1
    staging = archive.staging_dir(version)
    marked = watermark_column if watermark_column in source.columns else None
    staged, probe = with_hash(source), _probe(source) if plain else None
    if not plain:
        staged = stage_source(staged, f"{staging}/source")
    ends = archive.stored(ENDS, old) if old.ends() else None
    carried = tuple(c for c in carry if c in old.struct.fieldNames())
    sides = hash_difference(staged, archive.stored(OPEN, old), ends, marked, probe)
    highest = watermark_text(F.max("mark"), source.schema[marked].dataType) if marked else F.lit(None).cast("string")
    seen = Observation()
    measures = {
        "mark": highest,
        "new": F.count(F.when(F.expr(NEW), 1)),
        "new_rows": F.coalesce(F.sum(F.when(F.expr(NEW), F.col("here"))), F.lit(0)),
        "gone": F.count(F.when(F.expr(GONE), 1)),
        "gone_rows": F.coalesce(F.sum(F.when(F.expr(GONE), F.col("there"))), F.lit(0)),
    }
    if probe is not None:  # rows with the same JSON may differ in their raw form
        measures["mixed"] = F.count(F.when(F.expr(NEW) & (F.col("probe") != F.col("other_probe")), 1))
    changed = sides.observe(seen, *[m.alias(n) for n, m in measures.items()]).filter(f"({NEW}) OR ({GONE})").drop("mark", "other_probe")
    difference = stage_source(changed, f"{staging}/difference")
    sizes = seen.get

    parts, closed_rows = old.parts, 0
    if sizes["gone"] and close:
        directory, closed_rows = f"{archive.run_dir(version)}/{ENDS}", sizes["gone_rows"]
        upto, ended = F.lit(old.max_id).cast("long").alias("upto"), F.lit(now).cast("timestamp_ntz").alias("ended")
        gone = difference.filter(GONE).select("h", "after", upto, F.col("there").alias("copies"), ended)
        if carried:
            gone = _carried(archive.stored(OPEN, old), gone, sizes["gone"], carried)
        gone.write.mode("overwrite").options(**COMPRESSION).parquet(f"{archive.path}/{directory}")
        parts = (*parts, archive.part(directory, ENDS, closed_rows, sizes["gone"], carried))

    struct = evolve_schema(old.struct, as_versions(staged, archive, system, now).schema)
    inserted = 0
    if sizes["new"]:
        single = probe is not None and not sizes["mixed"]
        fresh = _new_rows(source if plain else staged, difference, sizes["new"], probe if single else None)
        versions = as_versions(stage_source(fresh, f"{staging}/fresh"), archive, system, now)
        written, added = _insert(versions, archive, struct, version, old.max_id, key=key or old.key)
        if written.rows != sizes["new_rows"]:
            raise RuntimeError("the source changed while it was loaded")
        parts, inserted = (*parts, *added), written.rows

    manifest = archive.commit(
        replace(
            old,
            version=version,
            schema=struct.jsonValue(),
            parts=parts,
            max_id=old.max_id + inserted,
            watermark=sizes["mark"] or old.watermark,
            watermark_type=mark_type(source, watermark_column) or old.watermark_type,
            key=key or old.key,
            modified=now,
            rows_loaded=inserted,
        )
    )
    return manifest, inserted, closed_rows


def load_view(
    archive: Archive,
    source: DataFrame | None,
    now: str,
    strategy: str | None = None,
    watermark_column: str | None = None,
    system: str = "SOURCE",
    close_unmarked: bool = False,
    plain: bool = False,
    carry: Sequence[str] = (),
    key: str | None = None,
) -> LoadResult:
    """Load one source with its strategy; errors come back in the result.

    An APPEND_ONLY archive without a watermark takes the rows that it does not hold; it closes others only if
    ``close_unmarked`` says so.  ``plain`` says that the source is a plain scan of files;
    ``carry`` is as in :func:`load_full`.  ``key`` names the column by which records are looked up; later loads keep it.
    """
    names = {"source": f"{archive.schema}.{archive.view}", "target": f"{archive.schema}.{archive.view}_archive"}
    strategy = strategy or FULL_COMPARE
    if source is None:
        reason = "source does not exist or is not accessible"
        return LoadResult(**names, status="skipped", reason=reason, timestamp=now)
    try:
        if key is not None and key not in source.columns:
            raise ValueError(f"the source has no key column {key}")
        old = archive.manifest()
        action, updated = "INCREMENTAL_LOAD", 0
        if old is None:
            action = "INITIAL_LOAD"
            _, inserted = load_initial(archive, source, now, system, watermark_column, plain, key)
        elif strategy == APPEND_ONLY and watermark_column and old.watermark is not None:
            _, inserted = load_append_only(archive, source, now, watermark_column, system, plain=plain, key=key)
        else:
            close = strategy != APPEND_ONLY or close_unmarked
            _, inserted, updated = load_full(archive, source, now, system, watermark_column, close, plain, carry, key)
    except Exception as error:  # a failed source must not stop the run
        archive.drop_staging()
        return LoadResult(**names, status="error", strategy=strategy, error=str(error), timestamp=now)
    return LoadResult(
        **names,
        status="success",
        action=action,
        strategy=strategy,
        rows_inserted=inserted,
        rows_updated=updated,
        timestamp=now,
    )
