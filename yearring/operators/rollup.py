"""Stored aggregates that follow the loads of an archive.

A rollup keeps, per period and dimensions, rows that merge: signed sums and counts, bitmaps of dense key numbers for exact distinct
counts, and quantile sketches.  :func:`refresh` reads only what loads added since the last refresh: new versions, and the ends, which carry
the columns that the rollup reads if the load was told to (``carry=rollup.reads``).

Sums are decimals, so that what ends subtracts exactly what it added.  Bitmaps and sketches can't be subtracted: the periods in
which rows ended are built again from the open versions.  Distinct counts are exact over any range of periods.  A quantile
is off by ``RANK_ERROR`` of the rows at most (with 99 % confidence), whatever the number of sketches merged.

Writes of one refresh become visible together: readers take the loads up to the last one whose deltas are complete.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearring.functions.hashing import hash_key
from yearring.operators.ids import write_numbered
from yearring.operators.scd import stage_source
from yearring.sources.store import CLOSED, COMPRESSION, ENDS, ENDS_SCHEMA, OPEN, Archive, Manifest, Part

#: Size parameter of the sketches, and the share of the rows that a rank may be off.
SKETCH_K, RANK_ERROR = 400, 0.01
_VALUE, _SIGN, _SUM = "decimal(24,6)", "decimal(10,0)", "decimal(38,6)"


@dataclass(frozen=True)
class Rollup:
    """``period``, ``dims`` and measures are SQL expressions over ``reads``, columns of the archive."""

    name: str
    reads: tuple[str, ...]
    period: str
    dims: dict[str, str] = field(default_factory=dict)
    sums: dict[str, str] = field(default_factory=dict)
    distincts: dict[str, str] = field(default_factory=dict)
    quantiles: dict[str, str] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return ["period", *self.dims]

    def keyed(self, rows: DataFrame, **more: Column | str) -> DataFrame:
        named = {"period": self.period, **self.dims, **more}
        return rows.select(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in named.items()])


class RollupStore:
    """The stored rows of a rollup, beside the parts of its archive."""

    def __init__(self, archive: Archive, rollup: Rollup):
        self.archive, self.rollup, self.fs = archive, rollup, archive.fs
        self.root = f"{archive.path}/rollups/{rollup.name}"

    # what is stored

    def generation(self) -> int | None:
        """Load from which on the rollup was built; a rebuild starts a new one."""
        complete = [n for n in self.fs.names(self.root) if self._complete(n)]
        return max((int(n.removeprefix("from=")) for n in complete), default=None)

    def _complete(self, generation: str) -> list[int]:
        deltas = f"{self.root}/{generation}/deltas"
        return [int(n.removeprefix("load=")) for n in self.fs.names(deltas) if self.fs.exists(f"{deltas}/{n}/_SUCCESS")]

    def applied(self) -> int | None:
        """Version of the archive that the rollup stands for."""
        generation = self.generation()
        return None if generation is None else max(self._complete(f"from={generation:08d}"))

    def _path(self, kind: str, load: int | None = None, generation: int | None = None) -> str:
        generation = self.generation() if generation is None else generation
        base = f"{self.root}/from={generation:08d}/{kind}"
        return base if load is None else f"{base}/load={load:08d}"

    def rows(self, kind: str, schema: T.StructType, upto: int | None = None, generation: int | None = None) -> DataFrame:
        """Stored rows of one kind, with the load that wrote them."""
        schema = T.StructType([*schema.fields, T.StructField("load", T.IntegerType())])
        spark, path = self.archive.spark, self._path(kind, generation=generation)
        if not self.fs.exists(path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path).filter(F.col("load") <= (self.applied() if upto is None else upto))

    def _key_fields(self) -> list[T.StructField]:
        empty = self.archive.spark.createDataFrame([], self.archive.manifest().struct)
        return self.rollup.keyed(empty).schema.fields

    def _schema(self, ddl: str) -> T.StructType:
        return T.StructType([*self._key_fields(), *T.StructType.fromDDL(ddl).fields])

    # reading

    def sums(self, start: str | None = None, end: str | None = None, by: Sequence[str] | None = None) -> DataFrame:
        """Counts and sums for periods from ``start`` up to but without ``end``, for ``by`` (all keys by default)."""
        names = list(self.rollup.sums)
        ddl = ", ".join(["n bigint", *[f"{n} {_SUM}, {n}_count bigint" for n in names]])
        rows = self._within(self.rows("deltas", self._schema(ddl)), start, end)
        total = [F.sum("n").alias("row_count"), *[F.sum(n).alias(n) for n in names], *[F.sum(f"{n}_count").alias(f"{n}_count") for n in names]]
        merged = rows.groupBy(*(self.rollup.keys if by is None else by)).agg(*total).filter("row_count > 0")
        return merged.select(*[c for c in merged.columns if c not in names and not c.endswith("_count")], "row_count", *[F.when(F.col(f"{n}_count") > 0, F.col(n)).alias(n) for n in names])

    def distinct(self, measure: str, start: str | None = None, end: str | None = None, by: Sequence[str] = ()) -> DataFrame:
        """Exact number of distinct values over a range of periods."""
        rows = self._merging("bits", "bucket bigint, bits binary, measure string", measure, start, end)
        merged = rows.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(measure))

    def quantile(self, measure: str, share: float, start: str | None = None, end: str | None = None, by: Sequence[str] = ()) -> DataFrame:
        """A quantile over a range of periods, from merged sketches."""
        rows = self._merging("sketches", "sketch binary, measure string", measure, start, end)
        merged = rows.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
        return merged.select(*by, F.kll_sketch_get_n_double("sketch").alias("row_count"), F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(measure))

    def _within(self, rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
        kind = rows.schema["period"].dataType
        if start is not None:
            rows = rows.filter(F.col("period") >= F.lit(start).cast(kind))
        return rows if end is None else rows.filter(F.col("period") < F.lit(end).cast(kind))

    def _merging(self, kind: str, ddl: str, measure: str, start: str | None, end: str | None) -> DataFrame:
        rows = self._within(self.rows(kind, self._schema(ddl)), start, end).filter(F.col("measure") == measure)
        period = T.StructType([f for f in self._key_fields() if f.name == "period"])
        if not self.fs.exists(self._path("rebuilt")):
            return rows
        # A period that was built again counts from there on.
        last = self.rows("rebuilt", period).groupBy("period").agg(F.max("load").alias("since")).withColumnRenamed("period", "_period")
        joined = rows.join(last, F.col("period").eqNullSafe(F.col("_period")), "left")
        return joined.filter(F.col("load") >= F.coalesce("since", F.lit(0)))

    # following the loads

    def refresh(self) -> int:
        """Apply what loads have added; returns the version of the archive that the rollup now stands for."""
        newest = self.archive.manifest()
        done = self.applied()
        if done == newest.version:
            return done
        parts = None if done is None else self._added(done, newest)
        if parts is None:
            self._build(newest)
        else:
            opened = self._stored(newest, [p for p in parts if p.state == OPEN])
            self._apply(newest, opened, self._ended(newest, [p for p in parts if p.state == ENDS]), self.generation())
        return newest.version

    def _build(self, newest: Manifest) -> None:
        """From all open versions, as a new generation."""
        self._apply(newest, self.archive.read(OPEN, newest).select(*self.rollup.reads), None, newest.version)

    def _added(self, done: int, newest: Manifest) -> list[Part] | None:
        """Parts that loads have added, or None if their manifests or parts are gone; clustering adds no rows."""
        fs, parts, before = self.fs, [], None
        for version in range(done, newest.version + 1):
            path = f"{self.archive.path}/_log/{version:08d}.json"
            if not fs.exists(path):
                return None
            manifest = Manifest.from_text(fs.read_text(path))
            if before is not None and manifest.parts[: len(before.parts)] == before.parts:
                parts += manifest.parts[len(before.parts) :]
            before = manifest
        return parts if all(fs.exists(f"{self.archive.path}/{p.dir}") for p in parts) else None

    def _stored(self, manifest: Manifest, parts: list[Part]) -> DataFrame:
        return self.archive.stored(OPEN, replace(manifest, parts=tuple(parts))).select(*self.rollup.reads)

    def _ended(self, manifest: Manifest, parts: list[Part]) -> DataFrame | None:
        """The rollup's columns of versions that ended, with their number of copies."""
        if not parts:
            return None
        reads = set(self.rollup.reads)
        carrying, bare = ([p for p in parts if (reads <= set(p.carries)) == side] for side in (True, False))
        found = []
        if carrying:
            carried = T.StructType([f for f in manifest.struct.fields if f.name in reads])
            struct = T.StructType.fromDDL(ENDS_SCHEMA).add("carried", carried)
            ends = self.archive.spark.read.schema(struct).parquet(*[f"{self.archive.path}/{p.dir}" for p in carrying])
            found.append(ends.select(*[F.col("carried")[c].alias(c) for c in self.rollup.reads], "copies"))
        if bare:  # these loads did not carry the columns: look the versions up
            if not all(self.fs.exists(f"{self.archive.path}/{p.dir}") for p in manifest.parts):
                raise FileNotFoundError("parts of the archive are gone")
            ends = self.archive.stored(ENDS, replace(manifest, parts=tuple(bare)))
            hit = (hash_key() == ends["h"]) & (F.col("_archive_id") > ends["after"]) & (F.col("_archive_id") <= ends["upto"])
            stored = self.archive.stored(OPEN, manifest).unionByName(self.archive.stored(CLOSED, manifest))
            found.append(stored.join(ends.select("h", "after", "upto"), hit, "left_semi").select(*self.rollup.reads, F.lit(1).cast("long").alias("copies")))
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def _apply(self, newest: Manifest, opened: DataFrame, ended: DataFrame | None, generation: int) -> None:
        rollup, load = self.rollup, newest.version
        fresh = opened
        if ended is not None and (rollup.distincts or rollup.quantiles):
            touched = rollup.keyed(ended).select("period").distinct()
            self._write(touched, "rebuilt", load, generation)
            again = self.archive.spark.read.schema(touched.schema).parquet(self._path("rebuilt", load, generation)).withColumnRenamed("period", "_period")
            same = F.expr(rollup.period).eqNullSafe(again["_period"])
            open_rows = self.archive.read(OPEN, newest).select(*rollup.reads)
            fresh = opened.join(again, same, "left_anti").unionByName(open_rows.join(again, same, "left_semi"))
            # Each measure reads these rows, and finding them may take a shuffle.
            fresh = stage_source(fresh, self.archive.staging_dir(load))
        for measure, value in rollup.distincts.items():
            self._write(self._bits(rollup.keyed(fresh, value=f"CAST({value} AS STRING)"), measure, load, generation), "bits", load, generation, measure)
        for measure, value in rollup.quantiles.items():
            rows = rollup.keyed(fresh, value=f"CAST({value} AS DOUBLE)").filter("value IS NOT NULL")
            sketches = rows.groupBy(*rollup.keys).agg(F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"))
            self._write(sketches, "sketches", load, generation, measure)
        self.archive.drop_staging()
        # Last: complete deltas are the commit.
        self._write(self._deltas(opened, ended), "deltas", load, generation)

    def _write(self, rows: DataFrame, kind: str, load: int, generation: int, measure: str | None = None) -> None:
        path = self._path(kind, load, generation)
        rows.write.mode("overwrite").options(**COMPRESSION).parquet(path if measure is None else f"{path}/measure={measure}")

    def _deltas(self, opened: DataFrame, ended: DataFrame | None) -> DataFrame:
        rollup = self.rollup
        rows = opened.withColumn("_sign", F.lit(1).cast("long"))
        if ended is not None:
            rows = rows.unionByName(ended.withColumnRenamed("copies", "_sign").withColumn("_sign", -F.col("_sign")))
        keyed = rollup.keyed(rows, _sign="_sign", **{n: f"CAST({e} AS {_VALUE})" for n, e in rollup.sums.items()})
        measures = [F.sum("_sign").alias("n")]
        for n in rollup.sums:
            measures.append(F.sum(F.col(n) * F.col("_sign").cast(_SIGN)).cast(_SUM).alias(n))
            measures.append(F.coalesce(F.sum(F.when(F.col(n).isNotNull(), F.col("_sign"))), F.lit(0)).alias(f"{n}_count"))
        return keyed.groupBy(*rollup.keys).agg(*measures)

    def _bits(self, rows: DataFrame, measure: str, load: int, generation: int) -> DataFrame:
        """Bitmaps over key numbers; values that are new get the next ones.

        Rows meet the numbers once per value, with the set of keys that have it, and travel to their bitmap as lists of bits: a bitmap
        for each task and key would be 4 kB for a few bits, so that volume grew with the square of the input.
        """
        schema, keys = T.StructType.fromDDL("id bigint, value string"), self.rollup.keys
        known = self.rows(f"values/{measure}", schema, load - 1, generation)
        new = rows.select("value").filter("value IS NOT NULL").distinct().join(known.select("value"), "value", "left_anti")
        staged = stage_source(new, self.archive.staging_dir(load))
        base = known.agg(F.max("id")).first()[0]
        write_numbered(staged, self._path(f"values/{measure}", load, generation), "id", -1 if base is None else base)
        numbers = self.rows(f"values/{measure}", schema, load, generation).select("id", "value")
        held = rows.filter("value IS NOT NULL").groupBy("value").agg(F.collect_set(F.struct(*keys)).alias("_keys"))
        placed = held.join(numbers.hint("shuffle_hash"), "value").select(F.explode("_keys").alias("_key"), "id").select("_key.*", "id")
        bucketed = placed.select(*keys, F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").cast("int").alias("bit"))
        listed = bucketed.groupBy(*keys, "bucket").agg(F.collect_list("bit").alias("bits"))
        single = listed.select(*keys, "bucket", F.explode("bits").alias("bit"))
        return single.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
