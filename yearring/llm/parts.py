"""Documents dealt into bounded parts on shared storage, and messages between parts and hash owners.

A *part* is a run of rows of at most ``PART_BYTES`` of text that one Python call can hold.
``parted`` writes the parts once, bucketed by part, so that later steps find a row under the same
``(part, row)`` even after a lost executor, and meet messages addressed to the part
without moving the texts again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearring.session import shared_dir

#: Rows and text bytes after which a part ends; a longer text is a part of its own.
PART_BYTES = 8 << 20
PART_ROWS = 1 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``written``, bucketed by ``key``, so that grouping or joining by it reads without a shuffle."""
    spark = df.sparkSession
    path, table = scratch(spark, name), f"llm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return out


def parted(
    df: DataFrame,
    text_col: str,
    name: str,
    more: Callable[[pa.Array], dict[str, pa.Array]] | None = None,
    more_schema: str = "",
) -> DataFrame:
    """Write ``df`` as ``part long, row int, data struct<columns of df>`` and what ``more`` computes from the texts.

    Texts of null count as empty.  Rows of one part are few enough for one task's memory.
    """
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("data"))
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("row", T.IntegerType()), *packed.schema.fields])
    if more_schema:
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(more_schema).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20
        for batch in batches:
            texts = batch.column(0).field(text_col)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_BYTES, "right")))
                stop = min(stop, at + PART_ROWS)
                piece = batch.slice(at, stop - at)
                n = piece.num_rows
                columns = [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(n, dtype=np.int32)), piece.column(0)]
                if more:
                    columns += more(piece.column(0).field(text_col)).values()
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                part += 1
                at = stop

    return bucketed(packed.mapInArrow(cut, schema), name, "part")


def row_number(part: Column, row: Column) -> Column:
    """One number for a row of a part."""
    return F.shiftleft(part, 20).bitwiseOR(row.cast("long"))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def ids_of(column: pa.ChunkedArray | pa.Array, null: int) -> np.ndarray:
    """Ids as int64, with ``null`` for those that are missing."""
    return pc.fill_null(column.cast(pa.int64()), null).to_numpy(zero_copy_only=False)


# Messages: sorted hashes, dealt to owners of equal hash ranges


def owners(spark: SparkSession) -> int:
    """Number of hash ranges; several to a task, so that a task can spread them."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def owner_cuts(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each owner's range begins in sorted 64-bit hashes; owner = top 32 bits scaled to n."""
    starts = (np.arange(n, dtype=np.uint64) << np.uint64(32)) // np.uint64(n)
    starts += (starts * np.uint64(n)) >> np.uint64(32) < np.arange(n, dtype=np.uint64)
    return np.append(np.searchsorted(hashes, starts << np.uint64(32)), len(hashes))


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted distinct uint64 as gaps, each in as many bytes as the widest gap takes."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    width = max(1, (int(gaps[1:].max()).bit_length() + 7) // 8) if len(gaps) > 1 else 1
    narrow = np.ascontiguousarray(gaps[1:].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(hashes[0]).to_bytes(8, "little") + np.ascontiguousarray(narrow).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    width = blob[0]
    narrow = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(narrow) + 1, 8), np.uint8)
    gaps[1:, :width] = narrow
    gaps = gaps.view("<u8").ravel()
    gaps[0] = int.from_bytes(blob[1:9], "little")
    return np.cumsum(gaps, dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest unsigned type that holds them all."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Group number of each row of sorted key columns."""
    fresh = np.zeros(len(keys[0]), bool)
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return np.cumsum(fresh)
