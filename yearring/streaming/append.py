"""Feeding an archive from a stream of files.

The checkpoint remembers which files are done, so no watermark is compared; the
archive remembers the last batch it took of each stream, so a batch that is replayed
after a crash is not stored twice.  A stream is known by a name kept in its checkpoint: batch numbers start anew with
every checkpoint.  The highest watermark is committed with the rows, so that a batch load can go on from there.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from yearring.functions.timefn import to_utc
from yearring.operators.ids import write_numbered
from yearring.functions.types import conform, evolve_schema
from yearring.operators.scd import HISTORY_COLUMNS, as_versions, later_mark, stage_source, watermark_text, with_hash
from yearring.sources.store import OPEN, Archive, Manifest, SharedFs, key_options


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, partitions: int | None = None
) -> DataFrame:
    """A stream over the files of a folder, in a session of its own.

    Streams are not coalesced at run time and keep the number of state partitions they start with, so the batch default of
    the session is seldom right for them: it is one per core, or ``partitions``.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    reader = own.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that owns a checkpoint, given on first use."""
    path, fs = f"{checkpoint.rstrip('/')}/archive-stream", SharedFs(spark, checkpoint)
    if not fs.exists(path):
        fs.write_new(path, uuid.uuid4().hex)
    return fs.read_text(path)


def append_batch(
    archive: Archive,
    batch: DataFrame,
    batch_id: int,
    now: str,
    system: str = "SOURCE",
    stream: str = "",
    watermark_column: str | None = None,
    plain: bool = False,
) -> int:
    """Store one micro-batch of a stream as open versions, once; ``plain`` if it is a plain scan of files, without state."""
    old = archive.manifest() or Manifest(created=now)
    if batch_id <= old.stream_batches.get(stream, -1):
        return 0
    version = old.version + 1
    hashed = batch if "_row_hash" in batch.columns else with_hash(batch)
    if not plain:
        hashed = stage_source(hashed, archive.staging_dir(version))
    versions = as_versions(hashed, archive, system, now)
    known = old.struct if old.schema else T.StructType([T.StructField("_archive_id", T.LongType())])
    struct = evolve_schema(known, versions.schema)
    directory = f"{archive.run_dir(version)}/{OPEN}"
    kind = struct[watermark_column].dataType if watermark_column else None
    mark = (F.col(watermark_column), lambda highest: watermark_text(highest, kind)) if watermark_column else ()
    written = write_numbered(conform(versions, struct), f"{archive.path}/{directory}", "_archive_id", old.max_id, *mark, options=key_options(old.key))
    latest = later_mark(archive.spark, old.watermark, written.mark, kind) if watermark_column else old.watermark
    parts = (archive.part(directory, OPEN, written.rows),) if written.rows else ()
    archive.commit(
        replace(
            old,
            version=version,
            schema=struct.jsonValue(),
            parts=(*old.parts, *parts),
            max_id=old.max_id + written.rows,
            modified=now,
            rows_loaded=written.rows,
            watermark=latest,
            watermark_type=kind.simpleString() if watermark_column else old.watermark_type,
            stream_batches={**old.stream_batches, stream: batch_id},
        )
    )
    return written.rows


def stream_append_only(
    source: DataFrame, archive: Archive, checkpoint: str, now: str, watermark_column: str | None = None, plain: bool = False
) -> StreamingQuery:
    """Load everything that has arrived, then stop."""
    stream = stream_name(source.sparkSession, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        append_batch(archive, batch, batch_id, now, stream=stream, watermark_column=watermark_column, plain=plain)

    writer = (
        source.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return writer.start()


def without_repeats(source: DataFrame, time_column: str, lateness: str) -> DataFrame:
    """Drop copies of a row that arrive within the allowed lateness, and rows later than that.

    The state holds one hash per row of the last ``lateness``; its size follows
    the arrival rate, not the length of the history.
    """
    columns = [c for c in source.columns if c not in HISTORY_COLUMNS]
    return (
        with_hash(source)
        .withColumn("_event_time", to_utc(time_column))
        .withWatermark("_event_time", lateness)
        .dropDuplicatesWithinWatermark(["_row_hash"])
        .select(*columns, F.col("_row_hash"))
    )


def stream_append_late(
    source: DataFrame, archive: Archive, checkpoint: str, now: str, time_column: str, lateness: str
) -> StreamingQuery:
    return stream_append_only(without_repeats(source, time_column, lateness), archive, checkpoint, now, time_column)
