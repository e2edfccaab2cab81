"""Archive tables as Parquet parts behind a versioned manifest.

Parquet has no UPDATE, so a load writes new parts and then commits one small
manifest naming the live ones.  Readers see either the old or the new state.

    <root>/<schema>/<view>/_log/00000003.json      manifest, one per commit
    <root>/<schema>/<view>/data/run=3-<token>/...  parts written by commit 3

The token differs for every writer, so one that loses the race for a commit has not touched the winner's files.

A part is a directory.  Versions are written once and never rewritten by a load: when rows end, the load appends *ends*,
narrow rows ``(hash, after, upto, copies, ended)``, which say that the versions of a hash with ids above ``after`` up to ``upto``
ended at that time.  Id ranges of a hash don't overlap, so a version has one end at most.  Readers resolve ends by one join: a broadcast
while their counted number is small, beyond that a shuffle join of the versions that a bitmap of the ends lets through; clustering
folds them into the parts.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearring.functions.hashing import hash_key

OPEN, CLOSED, ENDS = "open", "closed", "ends"
ENDS_SCHEMA = "h binary, after bigint, upto bigint, copies bigint, ended timestamp_ntz"
# About 70 bytes each: a million ends stay well inside a broadcast.
BROADCAST_ENDS = 1_000_000
# Upper bound of one row group's Bloom filter: three million keys at 1 % false positives.
KEY_FILTER_BYTES = 4 << 20
# Row hashes are hex text, which only an entropy coder brings near its 32 bytes.
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
# File systems whose rename is atomic and refuses an existing target.
RENAMING = ("hdfs", "viewfs")


class SharedFs:
    """The few file operations a commit needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def sizes(self, path: str) -> dict[str, int]:
        """Data files of a directory with their bytes."""
        return {
            s.getPath().getName(): s.getLen()
            for s in self._fs.listStatus(self._path(path))
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))
        }

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """Write a file that must not exist yet, so that two writers cannot both win.

        The text is complete before the name appears.  On a local disk the name is a hard link, which fails if it exists; elsewhere
        a rename, which has to be atomic and to refuse an existing target, as on HDFS.
        """
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                try:
                    os.link(*[self._path(p).toUri().getPath() for p in (draft, path)])
                except FileExistsError:
                    won = False
                else:
                    won = True
            elif self._fs.getUri().getScheme() not in RENAMING:
                raise ValueError(f"commits need a file system whose rename is atomic, so not {self._fs.getUri().getScheme()}")
            else:
                won = not self.exists(path) and self._fs.rename(self._path(draft), self._path(path))
        finally:
            self._fs.delete(self._path(draft), False)
        if not won:
            raise RuntimeError(f"another writer committed {path}")

    def drop_dir(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


@dataclass(frozen=True)
class Part:
    dir: str
    state: str
    #: Versions in it; for ends, the versions that they end.
    rows: int
    bytes: int = 0
    clustered: bool = False
    #: Number of ends, and the columns of the ended versions that they carry.
    ends: int = 0
    carries: tuple[str, ...] = ()


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    schema: dict = field(default_factory=dict)
    parts: tuple[Part, ...] = ()
    max_id: int = 0
    watermark: str | None = None
    created: str | None = None
    modified: str | None = None
    rows_loaded: int = 0
    #: Last batch of each stream that feeds the archive, by the identity of its checkpoint.
    stream_batches: dict[str, int] = field(default_factory=dict)
    #: Type of the watermark column, in DDL form.
    watermark_type: str | None = None
    #: Column that names a record; parts carry Bloom filters on it.
    key: str | None = None

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    def rows(self, state: str | None = None) -> int:
        """Versions as readers see them: what ends names is closed, wherever it is stored."""
        stored = {kind: sum(p.rows for p in self.parts if p.state == kind) for kind in (OPEN, CLOSED, ENDS)}
        seen = {OPEN: stored[OPEN] - stored[ENDS], CLOSED: stored[CLOSED] + stored[ENDS]}
        return seen[state] if state else sum(seen.values())

    def ends(self) -> int:
        return sum(p.ends for p in self.parts)

    def bytes(self) -> int:
        return sum(p.bytes for p in self.parts)

    def to_text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_text(cls, text: str) -> Manifest:
        raw = json.loads(text)
        raw["parts"] = tuple(Part(**{**p, "carries": tuple(p["carries"])}) for p in raw["parts"])
        return cls(**raw)


def key_options(key: str | None) -> dict[str, str]:
    """Write options that give each row group a Bloom filter on the key, as large as its distinct keys need.

    Row groups whose keys repeat enough for a dictionary are skipped by that instead.
    """
    if key is None:
        return {}
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(KEY_FILTER_BYTES),
    }


class Archive:
    """One archive table: its manifest, its reader and its commit."""

    def __init__(self, spark: SparkSession, root: str, schema: str, view: str):
        self.spark, self.schema, self.view = spark, schema, view
        self.path = f"{root.rstrip('/')}/{schema}/{view}"
        self.fs = SharedFs(spark, self.path)
        self.staged: list[str] = []

    def manifest(self) -> Manifest | None:
        """The newest committed manifest, or None before the first load."""
        names = [n for n in self.fs.names(f"{self.path}/_log") if n.endswith(".json")]
        return Manifest.from_text(self.fs.read_text(f"{self.path}/_log/{names[-1]}")) if names else None

    def run_dir(self, version: int) -> str:
        """A folder for parts that no other writer uses."""
        return f"data/run={version}-{uuid.uuid4().hex[:12]}"

    def staging_dir(self, version: int) -> str:
        """A folder for a load's intermediate rows, dropped when it commits or fails."""
        path = f"{self.path}/staging/run={version}-{uuid.uuid4().hex[:12]}"
        self.staged.append(path)
        return path

    def commit(self, manifest: Manifest) -> Manifest:
        self.fs.write_new(f"{self.path}/_log/{manifest.version:08d}.json", manifest.to_text())
        self.drop_staging()
        return manifest

    def drop_staging(self) -> None:
        while self.staged:
            self.fs.drop_dir(self.staged.pop())

    def part(self, directory: str, state: str, rows: int, ends: int = 0, carries: tuple[str, ...] = ()) -> Part:
        """Describe a directory that a load has just written."""
        return Part(directory, state, rows, sum(self.fs.sizes(f"{self.path}/{directory}").values()), ends=ends, carries=carries)

    def stored(self, state: str, manifest: Manifest) -> DataFrame:
        """Rows as they are in the parts of one state, ends not applied.

        The stored schema is given to the reader, so columns added later read as
        NULL from old parts and no file is opened to infer types.
        """
        struct = T.StructType.fromDDL(ENDS_SCHEMA) if state == ENDS else manifest.struct
        paths = [f"{self.path}/{p.dir}" for p in manifest.parts if p.state == state]
        if not paths:
            return self.spark.createDataFrame([], struct)
        return self.spark.read.schema(struct).option("recursiveFileLookup", "true").parquet(*paths)

    def read(self, state: str | None = None, manifest: Manifest | None = None) -> DataFrame:
        """All versions, or only the open or only the closed ones."""
        manifest = manifest or self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no archive at {self.path}")
        sides = []
        if state != CLOSED or manifest.ends():
            sides.append(self._resolved(state, manifest))
        if state != OPEN and (not sides or any(p.state == CLOSED for p in manifest.parts)):
            sides.append(self.stored(CLOSED, manifest))
        return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])

    def _resolved(self, state: str | None, manifest: Manifest) -> DataFrame:
        """Versions that were open when written, with the ends that came later."""
        versions = self.stored(OPEN, manifest)
        if not manifest.ends():
            return versions
        ends = self.stored(ENDS, manifest).select("h", "after", "upto", "ended")
        if manifest.ends() <= BROADCAST_ENDS:
            return self._ended(state, versions, F.broadcast(ends), hash_key())
        from yearring.operators.sieve import marked

        # As bytes, since the hex text would double what the join moves.
        bare = versions.withColumn("_row_hash", hash_key())
        sorted_out = marked(bare, F.xxhash64("_row_hash"), ends, F.xxhash64("h"), manifest.ends())
        met = self._ended(state, sorted_out.filter("_may").drop("_may"), ends, F.col("_row_hash"))
        found = met if state == CLOSED else met.unionByName(sorted_out.filter("NOT _may").drop("_may"))
        return found.withColumn("_row_hash", F.lower(F.hex("_row_hash")))

    @staticmethod
    def _ended(state: str | None, versions: DataFrame, ends: DataFrame, key: Column) -> DataFrame:
        hit = (key == ends["h"]) & (F.col("_archive_id") > ends["after"]) & (F.col("_archive_id") <= ends["upto"])
        if state == OPEN:
            return versions.join(ends, hit, "left_anti")
        current, until = F.col("_is_current") & F.col("ended").isNull(), F.coalesce("ended", "_valid_to")
        changed = {"_is_current": current, "_valid_to": until}
        joined = versions.join(ends, hit, "inner" if state == CLOSED else "left")
        return joined.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in versions.columns])

    def append_plain(self, rows: DataFrame, now: str) -> Manifest:
        """Append rows to a table that has no history columns (logs)."""
        from yearring.operators.ids import write_numbered

        old = self.manifest() or Manifest(created=now)
        version = old.version + 1
        directory = f"{self.run_dir(version)}/{OPEN}"
        written = write_numbered(rows, f"{self.path}/{directory}", "log_id", old.max_id)
        struct = T.StructType([T.StructField("log_id", T.LongType()), *rows.schema.fields])
        return self.commit(
            replace(
                old,
                version=version,
                schema=struct.jsonValue(),
                parts=(*old.parts, self.part(directory, OPEN, written.rows)),
                max_id=old.max_id + written.rows,
                modified=now,
                rows_loaded=written.rows,
            )
        )


class ArchiveStore:
    """A root folder of archives, addressed by (schema, view)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs = SharedFs(spark, self.root)

    def archive(self, schema: str, view: str) -> Archive:
        return Archive(self.spark, self.root, schema, view)

    def archives(self) -> list[Archive]:
        """Every committed archive under the root, in (schema, view) order."""
        found = []
        for schema in self.fs.names(self.root):
            for view in self.fs.names(f"{self.root}/{schema}"):
                archive = self.archive(schema, view)
                if archive.fs.exists(f"{archive.path}/_log"):
                    found.append(archive)
        return found

    def inventory(self) -> DataFrame:
        """One row per archive table, from the manifests: rows, bytes, created, modified."""
        rows = []
        for archive in self.archives():
            m = archive.manifest()
            rows.append((archive.schema, f"{archive.view}_archive", m.rows(), m.bytes(), m.created, m.modified))
        raw = self.spark.createDataFrame(
            rows,
            "source_schema string, table_name string, row_count bigint, bytes bigint, created_at string, last_modified string",
        )
        return raw.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "last_modified")})

    def register_views(self) -> list[str]:
        """Make every archive, the inventory and the load history readable by name in Spark SQL.

        Archive ``usage.users`` becomes ``usage_users_archive``.
        """
        from yearring.operators import control, monitor

        inventory = monitor.archive_inventory(self)
        views = {
            "vw_archive_inventory": inventory,
            "vw_archive_summary": monitor.archive_summary(inventory),
            "vw_load_history": monitor.load_history(control.load_log(self)),
        }
        views |= {f"{a.schema}_{a.view}_archive": a.read() for a in self.archives() if a.schema != "control"}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)
