"""Archives of the derived sources, loaded once per session and data folder."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import LOADED, SOURCES, access_texts, derive, spark_sql, table
from yearring.operators.control import RegistryEntry
from yearring.operators.heavy import HeavyHitters
from yearring.operators.pipeline import RunSummary, run_load
from yearring.operators.rollup import Rollup, RollupStore
from yearring.operators.scd import HISTORY_COLUMNS, LoadResult, load_view
from yearring.operators.text_index import TextIndex
from yearring.plans.rollups import DAILY_CREDITS, MONTHLY_CHARGES
from yearring.session import shared_dir
from yearring.sources.store import Archive, ArchiveStore

FIRST, SECOND, THIRD = "2024-02-01 06:00:00", "2024-02-02 06:00:00", "2024-02-03 06:00:00"
SCHEMA = "usage"


@dataclass
class Lab:
    spark: SparkSession
    sf_dir: str
    store: ArchiveStore
    lock: threading.RLock = field(default_factory=threading.RLock)
    loaded: dict[str, Archive] = field(default_factory=dict)
    history: tuple[Archive, list[LoadResult]] | None = None
    runs: tuple[ArchiveStore, list[RunSummary]] | None = None
    rolled: dict[str, RollupStore] = field(default_factory=dict)

    def archive(self, name: str) -> Archive:
        """The archive of a source after two loads: a first part, then everything."""
        with self.lock:
            if name not in self.loaded:
                self.loaded[name] = self._load(name)
            return self.loaded[name]

    def _load(self, name: str) -> Archive:
        source = SOURCES[name]
        archive = self.store.archive(SCHEMA, name)
        for now in (FIRST, SECOND):
            rows = self.source_at(name, now)
            result = load_view(archive, rows, now, source.strategy, source.watermark, plain=name in PLAIN)
            if result.status != "success":
                raise RuntimeError(result.error)
        return archive

    def source_at(self, name: str, now: str) -> DataFrame:
        """The source as the first load saw it, or as it stands now."""
        source, df = SOURCES[name], derive(self.spark, self.sf_dir, name)
        if now != FIRST:
            return df
        if source.cut:
            return df.filter(F.col(source.watermark) < F.lit(source.cut).cast("timestamp_ntz"))
        return self.before_change(name, df) if name in CHANGING else df

    @staticmethod
    def before_change(name: str, df: DataFrame) -> DataFrame:
        """An older state: a tenth of the rows differ and some rows are not there yet."""
        if name == "users":
            changed = F.when(F.col("user_id") % 10 == 3, "OLD_ROLE").otherwise(F.col("default_role"))
            return df.filter("user_id % 10 <> 9").withColumn("default_role", changed)
        if name == "table_storage":
            shrunk = F.when(F.col("id") % 10 == 3, F.col("active_bytes") - 1).otherwise(F.col("active_bytes"))
            return df.filter("id % 10 <> 9").withColumn("active_bytes", shrunk)
        return df.withColumn("granted_by", F.when(F.col("granted_by") == "G3", "G9").otherwise(F.col("granted_by")))

    def read(self, name: str, state: str | None = "open") -> DataFrame:
        """Archive rows with history columns; a projection reads its parent's archive."""
        source = SOURCES[name]
        if source.strategy:
            return self.archive(name).read(state)
        head = ", ".join(HISTORY_COLUMNS)
        text = spark_sql(name).replace("SELECT ", f"SELECT {head}, ", 1)
        return self.spark.sql(text, **{b: self.read(b, state) for b in source.base})


    def snapshots(self) -> tuple[Archive, list[LoadResult]]:
        """Users loaded three times: S1, S2 with changes and deletions, S1 again."""
        with self.lock:
            if self.history is None:
                archive = self.store.archive(SCHEMA, "user_snapshots")
                results = [
                    load_view(archive, df, now, "SOFT_DELETE_MUTABLE", plain=True, key="c_custkey")
                    for now, df in zip((FIRST, SECOND, THIRD), snapshots(self.spark, self.sf_dir))
                ]
                self.history = (archive, results)
            return self.history

    def texts(self) -> Archive:
        """Access rows kept as JSON text."""
        with self.lock:
            if "access_texts" not in self.loaded:
                archive = self.store.archive(SCHEMA, "access_texts")
                result = load_view(archive, access_texts(self.spark, self.sf_dir), FIRST, "APPEND_ONLY", "query_start_time", plain=True)
                if result.status != "success":
                    raise RuntimeError(result.error)
                self.loaded["access_texts"] = archive
            return self.loaded["access_texts"]

    def text_index(self) -> TextIndex:
        """Trigrams of the query texts; small blocks, since the test tables are small."""
        index = TextIndex(self.archive("query_history"), "query_text", 256)
        with self.lock:
            index.refresh()
        return index

    def frequent(self, column: str) -> HeavyHitters:
        """Daily summaries of a column of the query log."""
        heavy = HeavyHitters(self.archive("query_history"), column, "start_time")
        with self.lock:
            heavy.refresh()
        return heavy

    def rollup(self, rollup: Rollup) -> RollupStore:
        """A rollup that has followed its archive load by load: metering with changes and deletions, queries as they arrive."""
        with self.lock:
            if rollup.name not in self.rolled:
                metering = rollup in (DAILY_CREDITS, MONTHLY_CHARGES)
                name = "warehouse_metering" if metering else "query_history"
                archive, df, source = self.store.archive("rolled", name), derive(self.spark, self.sf_dir, name), SOURCES[name]
                frames = metering_states(df) if metering else [self.source_at(name, FIRST), df]
                stores = [RollupStore(archive, r) for r in ((DAILY_CREDITS, MONTHLY_CHARGES) if metering else (rollup,))]
                carry = sorted({c for s in stores for c in s.rollup.reads})
                for now, rows in zip((FIRST, SECOND, THIRD), frames):
                    strategy = "SOFT_DELETE_MUTABLE" if metering else "APPEND_ONLY"
                    result = load_view(archive, rows, now, strategy, source.watermark, plain=True, carry=carry)
                    if result.status != "success":
                        raise RuntimeError(result.error)
                    for store in stores:
                        store.refresh()
                self.rolled |= {s.rollup.name: s for s in stores}
            return self.rolled[rollup.name]

    def pipeline(self) -> tuple[ArchiveStore, list[RunSummary]]:
        """Two runs over the whole registry, in a store of their own."""
        with self.lock:
            if self.runs is None:
                store = ArchiveStore(self.spark, f"{self.store.root}-pipeline")
                runs = []
                for now in (FIRST, SECOND):

                    def read(schema: str, view: str, now: str = now) -> DataFrame | None:
                        if view == "absent_source":
                            return None
                        if view == "broken_source":
                            return table(self.spark, self.sf_dir, "no_such_table")
                        return self.source_at(view, now)

                    runs.append(run_load(store, REGISTRY, read, now, plain=PLAIN))
                self.runs = (store, runs)
            return self.runs


#: Sources that are a projection and filter of one table; the others aggregate or join.
PLAIN = frozenset(LOADED) - {"storage_daily", "grants_to_users"}
CHANGING = ("users", "table_storage", "grants_to_users")
_KEYS = {"query_history": "query_id", "login_history": "event_id", "users": "user_id", "roles": "role_id"}
REGISTRY = (
    *[
        RegistryEntry(SCHEMA, n, n != "accounts", SOURCES[n].strategy, SOURCES[n].watermark, _KEYS.get(n))
        for n in LOADED
    ],
    RegistryEntry(SCHEMA, "absent_source"),
    RegistryEntry(SCHEMA, "broken_source", True, "APPEND_ONLY", "v"),
)


def metering_states(metering: DataFrame) -> list[DataFrame]:
    """Three states: some rows not there yet, some charged more, some gone; the last is ``METERING_LAST`` in the checking SQL."""
    number = F.col("object_id") % 10
    raised = metering.withColumn("credits_used", F.when(number == 3, F.col("credits_used") + 2).otherwise(F.col("credits_used")))
    return [metering.filter(number != 9), raised, raised.filter(number != 5)]


METERING_LAST = """(SELECT * REPLACE (CASE WHEN object_id % 10 = 3 THEN credits_used + 2 ELSE credits_used END AS credits_used)
    FROM warehouse_metering WHERE object_id % 10 <> 5)"""


def snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three states of the customers: S1, S2, S1."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    raised = F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    s1, s2 = c.filter("c_custkey % 10 <> 9"), c.filter("c_custkey % 11 <> 0").withColumn("c_acctbal", raised)
    return [s1, s2, s1]


_LABS: dict[tuple[str, str], Lab] = {}
_GUARD = threading.Lock()


def lab(spark: SparkSession, sf_dir: str) -> Lab:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _GUARD:
        if key not in _LABS:
            root = f"{shared_dir(spark)}/yearring-{key[0]}-{uuid.uuid4().hex[:8]}"
            _LABS[key] = Lab(spark, sf_dir, ArchiveStore(spark, root))
        return _LABS[key]


def fresh_store(spark: SparkSession) -> ArchiveStore:
    """An empty store for queries that run loads themselves."""
    return ArchiveStore(spark, f"{shared_dir(spark)}/yearring-run-{uuid.uuid4().hex[:12]}")
