"""Loads, history and the pipeline."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import ASOF_ORDERS, LOADED, SOURCES, derive, table
from checks.lab import CHANGING, FIRST, PLAIN, REGISTRY, SECOND, THIRD, fresh_store, lab, snapshots
from checks.registry import check
from yearring.functions.hashing import row_hash, row_hash_concat
from yearring.operators import compaction, control, digests, lookup, monitor, scd, temporal
from yearring.session import shared_dir

END = "TIMESTAMP '9999-12-31 23:59:59'"
T1, T2, T3 = (f"TIMESTAMP '{t}'" for t in (FIRST, SECOND, THIRD))

# Every version of the three user snapshots, in closed form: a row is lost at S2
# when its key divides by 11 or its balance rose (key divides by 7).
VERSIONS = f"""
    SELECT c_custkey, c_name, c_acctbal, {T1} AS _valid_from, {END} AS _valid_to, TRUE AS _is_current
        FROM customer WHERE c_custkey % 10 <> 9 AND c_custkey % 11 <> 0 AND c_custkey % 7 <> 0
    UNION ALL SELECT c_custkey, c_name, c_acctbal, {T1}, {T2}, FALSE
        FROM customer WHERE c_custkey % 10 <> 9 AND (c_custkey % 11 = 0 OR c_custkey % 7 = 0)
    UNION ALL SELECT c_custkey, c_name, c_acctbal, {T3}, {END}, TRUE
        FROM customer WHERE c_custkey % 10 <> 9 AND (c_custkey % 11 = 0 OR c_custkey % 7 = 0)
    UNION ALL SELECT c_custkey, c_name, c_acctbal + 100, {T2}, {T3}, FALSE
        FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 = 0
    UNION ALL SELECT c_custkey, c_name, c_acctbal, {T2}, {T3}, FALSE
        FROM customer WHERE c_custkey % 10 = 9 AND c_custkey % 11 <> 0 AND c_custkey % 7 <> 0"""
BODY = "c_custkey, c_name, ROUND(c_acctbal, 6) AS c_acctbal, _valid_from, _valid_to, _is_current"
COLUMNS = ["c_custkey", "c_name", "c_acctbal", "_valid_from", "_valid_to", "_is_current"]


def versions(select: str = BODY, rest: str = "") -> str:
    return f"WITH v AS ({VERSIONS}) SELECT {select} FROM v {rest}"


def history(spark: SparkSession, sf_dir: str, state: str | None = None) -> DataFrame:
    return lab(spark, sf_dir).snapshots()[0].read(state)


# ---- scans, sources, sinks ------------------------------------------------

check("scan_source", "SELECT user_id, name, default_role, last_success_login FROM users")(
    lambda s, d: derive(s, d, "users").select("user_id", "name", "default_role", "last_success_login")
)

check(
    "scan_delta",
    "SELECT query_id, start_time, user_name FROM query_history WHERE start_time > TIMESTAMP '2024-01-21 00:00:00'",
)(
    lambda s, d: scd.scan_delta(derive(s, d, "query_history"), "start_time", "2024-01-21 00:00:00").select(
        "query_id", "start_time", "user_name"
    )
)

check("scan_archive", versions())(lambda s, d: history(s, d).select(*COLUMNS))


def _fresh_load(spark: SparkSession, sf_dir: str, *frames: DataFrame, name: str = "users", **options):
    archive = fresh_store(spark).archive("usage", name)
    times = (FIRST, SECOND, THIRD)
    results = [scd.load_view(archive, df, now, plain=name in PLAIN, **options) for now, df in zip(times, frames)]
    for result in results:
        if result.status == "error":
            raise RuntimeError(result.error)
    return archive, results


def _counts(spark: SparkSession, results) -> DataFrame:
    rows = [(i + 1, r.action, r.status, r.rows_inserted, r.rows_updated) for i, r in enumerate(results)]
    return spark.createDataFrame(rows, "load int, action string, status string, rows_inserted bigint, rows_updated bigint")


@check(
    "source_exists",
    """SELECT 'users' AS source, 'success' AS status, COUNT(*) AS rows_inserted FROM customer
       UNION ALL SELECT 'absent', 'skipped', 0""",
)
def _source_exists(spark, sf_dir):
    store = fresh_store(spark)
    found = {"users": derive(spark, sf_dir, "users"), "absent": None}
    loads = [(n, scd.load_view(store.archive("usage", n), df, FIRST)) for n, df in found.items()]
    return spark.createDataFrame(
        [(n, r.status, r.rows_inserted) for n, r in loads], "source string, status string, rows_inserted bigint"
    )


check(
    "create_archive",
    f"""SELECT id, table_name, 'SOURCE_usage' AS _source_system, 'tables' AS _source_table, TRUE AS _is_current,
        {T1} AS _loaded_at, {T1} AS _valid_from, {END} AS _valid_to FROM table_storage""",
)(
    lambda s, d: _fresh_load(s, d, derive(s, d, "table_storage"), name="tables")[0]
    .read()
    .select("id", "table_name", "_source_system", "_source_table", "_is_current", "_loaded_at", "_valid_from", "_valid_to")
)

check(
    "append_archive",
    f"SELECT query_id, user_name, {T2} AS _loaded_at FROM query_history WHERE start_time >= TIMESTAMP '2024-01-11'",
)(
    lambda s, d: lab(s, d)
    .read("query_history")
    .filter(F.col("_loaded_at") == F.lit(SECOND).cast("timestamp_ntz"))
    .select("query_id", "user_name", "_loaded_at")
)

check("stage_source", "SELECT COUNT(*) AS staged_rows, COUNT(DISTINCT user_id) AS hashes FROM users")(
    lambda s, d: scd.stage_source(
        scd.with_hash(derive(s, d, "users")), f"{shared_dir(s)}/yearring-stage-{uuid.uuid4().hex[:12]}"
    ).agg(F.count("*").alias("staged_rows"), F.countDistinct("_row_hash").alias("hashes"))
)

check("sample_archive", "SELECT LEAST(COUNT(*), 20000) AS sampled, LEAST(COUNT(*), 20000) AS current_rows FROM users")(
    lambda s, d: monitor.sample_archive(lab(s, d).read("users", None), limit=20_000).agg(
        F.count("*").alias("sampled"), F.count(F.when(F.col("_is_current"), 1)).alias("current_rows")
    )
)


@check("export_csv", "SELECT CAST(user_id AS VARCHAR) AS user_id, name, default_role FROM users")
def _export_csv(spark, sf_dir):
    report = lab(spark, sf_dir).read("users").select("user_id", "name", "default_role")
    path = monitor.export_csv(report, f"{shared_dir(spark)}/yearring-csv-{uuid.uuid4().hex[:12]}")
    return spark.read.option("header", True).csv(path, schema="user_id string, name string, default_role string")


# ---- hashes ---------------------------------------------------------------

check(
    "row_hash",
    """SELECT id, sha256('{"active_bytes":' || active_bytes || ',"failsafe_bytes":' || failsafe_bytes || ',"id":' || id
        || ',"is_transient":"' || is_transient || '","retained_for_clone_bytes":' || retained_for_clone_bytes
        || ',"table_catalog":"' || table_catalog || '","table_name":"' || table_name || '","table_schema":"' || table_schema
        || '","time_travel_bytes":' || time_travel_bytes || '}') AS row_hash FROM table_storage""",
)(lambda s, d: (lambda t: t.select("id", row_hash(t.schema).alias("row_hash")))(derive(s, d, "table_storage")))

check(
    "row_hash_concat",
    "SELECT user_id, sha256(concat_ws('|', user_id, name, CAST(has_mfa AS VARCHAR), default_role)) AS row_hash FROM users",
)(
    lambda s, d: derive(s, d, "users").select(
        "user_id", row_hash_concat(["user_id", "name", "has_mfa", "default_role"]).alias("row_hash")
    )
)

check(
    "verify_hash",
    f"""WITH v AS ({VERSIONS}) SELECT 'user_snapshots' AS _source_table, COUNT(*) AS versions, CAST(0 AS BIGINT) AS mismatches FROM v
        UNION ALL SELECT 'query_history', COUNT(*), 0 FROM query_history""",
)(
    lambda s, d: temporal.verify_hash(history(s, d)).unionByName(
        temporal.verify_hash(lab(s, d).read("query_history", None))
    )
)

# ---- load strategies ------------------------------------------------------

check(
    "scd2_initial",
    f"SELECT run_id, name, TRUE AS _is_current, {T1} AS _loaded_at, {T1} AS _valid_from, {END} AS _valid_to FROM task_history",
)(
    lambda s, d: _fresh_load(s, d, derive(s, d, "task_history"), name="task_history")[0]
    .read()
    .select("run_id", "name", "_is_current", "_loaded_at", "_valid_from", "_valid_to")
)


@check(
    "scd2_append_only",
    """WITH b AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS load FROM events)
       SELECT CAST(load AS INT) AS load, CASE load WHEN 1 THEN 'INITIAL_LOAD' ELSE 'INCREMENTAL_LOAD' END AS action, 'success' AS status,
           COUNT(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated FROM b GROUP BY load""",
)
def _append_only(spark, sf_dir):
    log = derive(spark, sf_dir, "query_history")
    first = log.filter("start_time < TIMESTAMP_NTZ '2024-01-11'")
    # Late rows and rows without a time must not load.
    late = first.filter("query_type = 'SIGNUP'").withColumn("query_id", -F.col("query_id") - 1)
    untimed = late.withColumn("start_time", F.lit(None).cast("timestamp_ntz"))
    second = log.filter("start_time < TIMESTAMP_NTZ '2024-01-21'").unionByName(late).unionByName(untimed)
    _, results = _fresh_load(
        spark, sf_dir, first, second, log, name="query_history", strategy="APPEND_ONLY", watermark_column="start_time"
    )
    return _counts(spark, results)


@check("scd2_append_ties", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT o_orderkey) AS keys, COUNT(*) AS ids FROM orders")
def _append_ties(spark, sf_dir):
    """The inclusive form over all orders: half the rows of the boundary day arrive with the next load."""
    runs = derive(spark, sf_dir, "task_history")
    archive, _ = _fresh_load(
        spark,
        sf_dir,
        runs.filter("scheduled_time < TIMESTAMP_NTZ '2000-06-01' OR scheduled_time = TIMESTAMP_NTZ '2000-06-01' AND run_id % 2 = 0"),
        name="task_history",
        watermark_column="scheduled_time",
    )
    scd.load_append_only(archive, runs, SECOND, "scheduled_time", inclusive=True)
    return archive.read().agg(
        F.count("*").alias("row_count"), F.countDistinct("run_id").alias("keys"), F.max("_archive_id").alias("ids")
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")


check("scd2_full", versions())(lambda s, d: history(s, d).select(*COLUMNS))
check("scd2_close", versions(rest="WHERE NOT _is_current"))(lambda s, d: history(s, d, "closed").select(*COLUMNS))
check("scd2_insert_new", versions(rest=f"WHERE _valid_from > {T1}"))(
    lambda s, d: history(s, d).filter(F.col("_valid_from") > F.lit(FIRST).cast("timestamp_ntz")).select(*COLUMNS)
)
check(
    "scd2_delete_detection",
    f"""SELECT c_custkey, {T1} AS opened, {T2} AS closed, {T3} AS reopened FROM customer
        WHERE c_custkey % 10 <> 9 AND c_custkey % 11 = 0""",
)(
    lambda s, d: history(s, d)
    .filter("c_custkey % 11 = 0")
    .groupBy("c_custkey")
    .agg(F.min("_valid_from").alias("opened"), F.min("_valid_to").alias("closed"), F.max("_valid_from").alias("reopened"))
)

check(
    "scd2_load_counts",
    """
    WITH c AS (SELECT COUNT(*) FILTER (c_custkey % 10 <> 9) AS s1,
        COUNT(*) FILTER (c_custkey % 10 <> 9 AND (c_custkey % 11 = 0 OR c_custkey % 7 = 0)) AS lost,
        COUNT(*) FILTER (c_custkey % 11 <> 0 AND (c_custkey % 7 = 0 OR c_custkey % 10 = 9)) AS won FROM customer)
    SELECT 1 AS load, 'INITIAL_LOAD' AS action, 'success' AS status, s1 AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated FROM c
    UNION ALL SELECT 2, 'INCREMENTAL_LOAD', 'success', won, lost FROM c
    UNION ALL SELECT 3, 'INCREMENTAL_LOAD', 'success', lost, won FROM c""",
)(lambda s, d: _counts(s, lab(s, d).snapshots()[1]))

check(
    "scd2_duplicates",
    """SELECT CAST(c_custkey % 10 = 0 AS BOOLEAN) AS doubled, COUNT(*) AS users,
           CAST(SUM(CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS versions
       FROM customer GROUP BY 1""",
)(
    lambda s, d: (
        lambda all_of: _fresh_load(s, d, all_of.unionByName(all_of.filter("c_custkey % 10 = 0")), all_of)[0]
        .read("open")
        .groupBy((F.col("c_custkey") % 10 == 0).alias("doubled"))
        .agg(F.countDistinct("c_custkey").alias("users"), F.count("*").alias("versions"))
    )(_customers(s, d))
)

check(
    "surrogate_id",
    versions("COUNT(*) AS versions, COUNT(*) AS distinct_ids, CAST(1 AS BIGINT) AS first_id, COUNT(*) AS last_id"),
)(
    lambda s, d: history(s, d).agg(
        F.count("*").alias("versions"),
        F.countDistinct("_archive_id").alias("distinct_ids"),
        F.min("_archive_id").alias("first_id"),
        F.max("_archive_id").alias("last_id"),
    )
)

check("watermark_get", "SELECT 'login_history' AS source_view, MAX(ts) AS last_watermark_value FROM events")(
    lambda s, d: s.createDataFrame(
        [("login_history", control.watermark_get(lab(s, d).archive("login_history")))], "source_view string, w string"
    ).select("source_view", F.col("w").cast("timestamp_ntz").alias("last_watermark_value"))
)


@check(
    "watermark_set",
    """SELECT event_type AS source_view, MAX(ts) AS last_watermark_value,
           COALESCE(NULLIF(COUNT(*) FILTER (ts >= TIMESTAMP '2024-01-21'), 0), COUNT(*)) AS rows_loaded
       FROM events GROUP BY 1""",
)
def _watermark_set(spark, sf_dir):
    """What two append loads of each event type have committed: early rows, then all."""
    events, store = table(spark, sf_dir, "events"), fresh_store(spark)
    for kind in sorted(r["event_type"] for r in events.select("event_type").distinct().collect()):
        mine = events.filter(F.col("event_type") == kind)
        for now, rows in ((FIRST, mine.filter("ts < TIMESTAMP_NTZ '2024-01-21'")), (SECOND, mine)):
            result = scd.load_view(store.archive("events", kind), rows, now, "APPEND_ONLY", "ts")
            if result.status != "success":
                raise RuntimeError(result.error)
    return control.watermark_state(store).select("source_view", "last_watermark_value", "rows_loaded")


@check(
    "watermark_types",
    """SELECT 'by_date' AS source_view, 'date' AS watermark_type, CAST(CAST(MAX(ts) AS DATE) AS VARCHAR) AS last_watermark,
           CAST(CAST(MAX(ts) AS DATE) AS TIMESTAMP) AS last_watermark_value FROM events
       UNION ALL SELECT 'by_id', 'bigint', CAST(MAX(event_id) AS VARCHAR), NULL FROM events
       UNION ALL SELECT 'by_instant', 'timestamp', CAST(epoch_us(MAX(ts)) AS VARCHAR), MAX(ts) FROM events""",
)
def _watermark_types(spark, sf_dir):
    """Watermarks that are dates, numbers and instants, in one report."""
    events, store = table(spark, sf_dir, "events"), fresh_store(spark)
    instant = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', ts)"))
    marks = {"by_date": F.col("ts").cast("date"), "by_id": F.col("event_id").cast("bigint"), "by_instant": instant}
    for name, mark in marks.items():
        result = scd.load_view(store.archive("events", name), events.withColumn("mark", mark), FIRST, "APPEND_ONLY", "mark")
        if result.status != "success":
            raise RuntimeError(result.error)
    return control.watermark_state(store).select("source_view", "watermark_type", "last_watermark", "last_watermark_value")


@check(
    "schema_evolve",
    f"""WITH c AS (SELECT c_custkey, c_custkey % 4 = 0 AS changed, CAST(c_custkey % 100 AS INT) AS cents FROM customer),
        v AS (SELECT *, TRUE AS _is_current FROM c UNION ALL SELECT *, FALSE FROM c WHERE changed)
        SELECT c_custkey, CAST(CASE WHEN changed AND _is_current THEN cents + 0.25 ELSE cents END AS DOUBLE) AS price,
            CASE WHEN changed AND _is_current THEN 'v' END AS note, c_custkey AS place,
            CASE WHEN changed AND _is_current THEN {T2} ELSE {T1} END AS _valid_from, _is_current, CAST(0 AS BIGINT) AS mismatches FROM v""",
)
def _schema_evolve(spark, sf_dir):
    """A wider decimal, a new nested field and another letter case, on all customers; only changed rows open versions."""
    cents = (F.col("c_custkey") % 100).cast("int")
    base = _customers(spark, sf_dir).select("c_custkey", cents.cast("decimal(10,2)").alias("price"), F.struct(F.col("c_custkey").alias("place")).alias("info"))
    changed = F.col("c_custkey") % 4 == 0
    grown = base.select(
        F.col("c_custkey").alias("C_CUSTKEY"),
        (F.col("price").cast("decimal(10,4)") + F.when(changed, F.lit(0.25).cast("decimal(2,2)")).otherwise(0)).cast("decimal(12,4)").alias("Price"),
        F.struct(F.when(changed, "v").alias("note"), F.col("info.place").alias("PLACE")).alias("info"),
    )
    archive, _ = _fresh_load(spark, sf_dir, base, grown)
    wrong = temporal.verify_hash(archive.read()).agg(F.coalesce(F.sum("mismatches"), F.lit(0)).alias("n")).first()["n"]
    price = F.col("price").cast("double").alias("price")
    out = archive.read().select("c_custkey", price, "info.note", "info.place", "_valid_from", "_is_current")
    return out.withColumn("mismatches", F.lit(wrong).cast("bigint"))


def _run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = lab(spark, sf_dir).pipeline()[1]
    rows = [
        (run.run_id, x.source, x.status, x.strategy, x.rows_inserted, x.rows_updated)
        for run in runs
        for x in run.table_results
    ]
    return spark.createDataFrame(
        rows, "run_id bigint, source string, status string, strategy string, rows_inserted bigint, rows_updated bigint"
    )


def _expected_runs() -> str:
    """Rows each source should report in the two runs, from the sources themselves."""
    branches = [
        "SELECT 1 AS run_id, 'usage.absent_source' AS source, 'skipped' AS status, CAST(NULL AS VARCHAR) AS strategy, 0 AS rows_inserted, 0 AS rows_updated",
        "SELECT 2, 'usage.absent_source', 'skipped', NULL, 0, 0",
        "SELECT 1, 'usage.broken_source', 'error', 'APPEND_ONLY', 0, 0",
        "SELECT 2, 'usage.broken_source', 'error', 'APPEND_ONLY', 0, 0",
    ]
    first = {"users": "user_id % 10 <> 9", "table_storage": "id % 10 <> 9"}
    fresh = {"users": "user_id % 10 IN (3, 9)", "table_storage": "id % 10 IN (3, 9)", "grants_to_users": "granted_by = 'G3'"}
    gone = {"users": "user_id % 10 = 3", "table_storage": "id % 10 = 3", "grants_to_users": "granted_by = 'G3'"}
    for entry in REGISTRY:
        name = entry.source_view
        if name not in SOURCES or not entry.is_active:
            continue
        source = SOURCES[name]
        if source.cut:
            one = f"{source.watermark} < TIMESTAMP '{source.cut}'"
            two, closed = f"{source.watermark} >= TIMESTAMP '{source.cut}'", "FALSE"
        elif name in CHANGING:
            one, two, closed = first.get(name, "TRUE"), fresh[name], gone[name]
        else:
            one, two, closed = "TRUE", "FALSE", "FALSE"
        for run, cond, gone_cond in ((1, one, "FALSE"), (2, two, closed)):
            branches.append(
                f"SELECT {run}, 'usage.{name}', 'success', '{source.strategy}', COUNT(*) FILTER ({cond}), "
                f"COUNT(*) FILTER ({gone_cond}) FROM {name}"
            )
    return " UNION ALL ".join(branches)


_RUN_COLUMNS = "CAST(run_id AS BIGINT) AS run_id, source, status, strategy, CAST(rows_inserted AS BIGINT) AS rows_inserted, CAST(rows_updated AS BIGINT) AS rows_updated"
_FIXED = f"WITH x AS ({_expected_runs()}) SELECT {_RUN_COLUMNS.replace('strategy,', '''CASE WHEN status = 'skipped' THEN NULL ELSE strategy END AS strategy,''')} FROM x"
check("run_load", _FIXED)(_run_rows)
check(
    "strategy_dispatch",
    f"WITH x AS ({_expected_runs()}) SELECT source, strategy, CAST(SUM(rows_updated) AS BIGINT) AS rows_updated FROM x WHERE status = 'success' GROUP BY 1, 2",
)(
    lambda s, d: control.load_log(lab(s, d).pipeline()[0])
    .filter("status = 'SUCCESS'")
    .groupBy(F.col("source_table").alias("source"), F.col("load_strategy").alias("strategy"))
    .agg(F.sum("rows_updated").alias("rows_updated"))
)
check(
    "load_view",
    """SELECT 'usage.users' AS source, 'usage.users_archive' AS target, 'INITIAL_LOAD' AS action, 'FULL_COMPARE' AS strategy,
           COUNT(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, 'success' AS status FROM users""",
)(
    lambda s, d: s.createDataFrame(
        [
            (x.source, x.target, x.action, x.strategy, x.rows_inserted, x.rows_updated, x.status)
            for x in _fresh_load(s, d, derive(s, d, "users"))[1]
        ],
        "source string, target string, action string, strategy string, rows_inserted bigint, rows_updated bigint, status string",
    )
)

# ---- temporal -------------------------------------------------------------

check("current_state", versions(rest="WHERE _is_current"))(
    lambda s, d: temporal.current_state(history(s, d, "open")).select(*COLUMNS)
)
_AT = "2024-02-02 18:00:00"
check("as_of", versions(rest=f"WHERE _valid_from <= TIMESTAMP '{_AT}' AND _valid_to > TIMESTAMP '{_AT}'"))(
    lambda s, d: temporal.as_of(history(s, d), _AT).select(*COLUMNS)
)
check(
    "as_of_null_end",
    """SELECT c_custkey, ROUND(CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END, 6) AS c_acctbal
       FROM customer WHERE c_custkey % 11 <> 0""",
)(
    lambda s, d: temporal.as_of(
        history(s, d).withColumn("_valid_to", F.when(~F.col("_is_current"), F.col("_valid_to"))), SECOND
    ).select("c_custkey", "c_acctbal")
)
check("digest_root", versions("CAST(COUNT(*) AS BIGINT) AS versions, CAST(0 AS BIGINT) AS mismatches, CAST(0 AS BIGINT) AS differing"))(
    lambda s, d: _digest_root(s, d)
)


def _digest_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = digests.DigestTree(lab(spark, sf_dir).snapshots()[0], 256)
    tree.refresh()
    zero = F.lit(0).cast("bigint")
    differing = tree.verify().select(zero.alias("versions"), zero.alias("mismatches"), F.lit(1).alias("differing"))
    whole = tree.root().select("versions", "mismatches", F.lit(0).alias("differing")).unionByName(differing)
    return whole.agg(*[F.sum(c).alias(c) for c in whole.columns])


@check(
    "digest_located",
    """SELECT c_custkey, CAST(ROUND(c_acctbal, 6) AS DOUBLE) AS c_acctbal, CAST(ROUND(c_acctbal + 1, 6) AS DOUBLE) AS in_copy
       FROM customer WHERE c_name = 'Customer#000000077'""",
)
def _digest_located(spark, sf_dir):
    """A copy of an archive in which one row was altered: the trees name its block, the sums its id."""
    store = fresh_store(spark)
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    altered = F.when(F.col("c_name") == "Customer#000000077", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    archives, trees = [], []
    for name, df in {"original": rows, "copy": rows.withColumn("c_acctbal", altered)}.items():
        archive = store.archive("usage", name)
        scd.load_initial(archive, df, FIRST, plain=True)
        archives.append(archive.read())
        trees.append(digests.DigestTree(archive, 256))
        trees[-1].refresh()
    suspects = digests.differing_blocks(*trees).select(F.col("suspect").alias("_archive_id"))
    original, copy = archives
    both = original.join(F.broadcast(suspects), "_archive_id").join(copy.select("_archive_id", F.col("c_acctbal").alias("in_copy")), "_archive_id")
    return both.select("c_custkey", "c_acctbal", "in_copy")


def _dearest_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_totalprice").alias("o_totalprice"))
    return orders.join(F.broadcast(top), "o_totalprice").select("o_custkey")


check("record_history", versions(rest="WHERE c_name = 'Customer#000000077'"))(
    lambda s, d: temporal.record_history(history(s, d), F.col("c_name") == "Customer#000000077").select(*COLUMNS)
)
check(
    "key_lookup",
    versions(rest="WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 150000)"),
)(
    lambda s, d: lookup.key_lookup(
        lab(s, d).snapshots()[0], table(s, d, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 150000").select("o_custkey")
    ).select(*COLUMNS)
)
check(
    "key_lookup_few",
    versions(rest="WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM orders))"),
)(lambda s, d: lookup.key_lookup(lab(s, d).snapshots()[0], _dearest_customer(s, d)).select(*COLUMNS))
check("changes_between", versions(rest=f"WHERE _valid_from BETWEEN {T2} AND {T3}"))(
    lambda s, d: temporal.changes_between(history(s, d), SECOND, THIRD).select(*COLUMNS)
)
check("change_counts", versions("'user_snapshots' AS table_name, COUNT(*) AS changes", f"WHERE _valid_from >= {T2}"))(
    lambda s, d: temporal.change_counts(history(s, d), SECOND)
)
check(
    "deleted_records",
    versions(
        rest="WHERE NOT _is_current AND NOT EXISTS (SELECT 1 FROM v AS n WHERE n.c_custkey = v.c_custkey AND n._is_current)"
    ),
)(
    lambda s, d: temporal.deleted_records(history(s, d, "closed"), history(s, d, "open"), ["c_custkey"]).select(*COLUMNS)
)
check(
    "validity_days",
    versions(
        "c_custkey, _valid_from, CAST(date_diff('day', _valid_from, CASE WHEN _is_current THEN TIMESTAMP '2024-03-01' ELSE _valid_to END) AS INT) AS days_in_force"
    ),
)(
    lambda s, d: history(s, d).select(
        "c_custkey", "_valid_from", temporal.validity_days("2024-03-01 00:00:00").alias("days_in_force")
    )
)
check(
    "duplicate_current",
    "SELECT 'users' AS _source_table, CAST(SUM(CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS dupes FROM customer",
)(
    lambda s, d: (
        lambda all_of: temporal.duplicate_current(
            _fresh_load(s, d, all_of.unionByName(all_of.filter("c_custkey % 10 = 0")))[0].read()
        )
    )(_customers(s, d))
)


@check(
    "archive_cluster",
    versions(f"_is_current, _valid_from AS _loaded_at, COUNT(*) AS versions", "GROUP BY 1, 2"),
)
def _archive_cluster(spark, sf_dir):
    archive, _ = _fresh_load(spark, sf_dir, *snapshots(spark, sf_dir))
    compaction.cluster_archive(archive, THIRD)
    return archive.read().groupBy("_is_current", "_loaded_at").agg(F.count("*").alias("versions"))


@check("archive_vacuum", versions(f"_is_current, _valid_from AS _loaded_at, COUNT(*) AS versions, TRUE AS deleted", "GROUP BY 1, 2"))
def _archive_vacuum(spark, sf_dir):
    """Clustered twice and vacuumed: the versions are the same, the superseded files are gone."""
    archive, _ = _fresh_load(spark, sf_dir, *snapshots(spark, sf_dir))
    compaction.cluster_archive(archive, THIRD)
    compaction.cluster_archive(archive, THIRD, everything=True)
    deleted = compaction.vacuum(archive)
    counts = archive.read().groupBy("_is_current", "_loaded_at").agg(F.count("*").alias("versions"))
    return counts.withColumn("deleted", F.lit(deleted > 0))


# ---- control tables and monitoring ----------------------------------------


def _registry(spark: SparkSession) -> DataFrame:
    return control.registry_table(spark, REGISTRY, FIRST)


def _source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source, counted on the sources themselves."""
    counted = monitor.row_count_union({n: derive(spark, sf_dir, n) for n in LOADED})
    return counted.select(F.lit("usage").alias("source_schema"), F.col("table_name").alias("source_view"), "row_count")


_REGISTRY_SQL = " UNION ALL ".join(
    f"SELECT '{e.source_schema}' AS source_schema, '{e.source_view}' AS source_view, {e.is_active} AS is_active, "
    f"'{e.load_strategy}' AS load_strategy, {repr(e.watermark_column) if e.watermark_column else 'CAST(NULL AS VARCHAR)'} AS watermark_column, "
    f"{repr(e.unique_key_column) if e.unique_key_column else 'CAST(NULL AS VARCHAR)'} AS unique_key_column"
    for e in REGISTRY
)
_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{n}' AS source_view, COUNT(*) AS row_count FROM {n}" for n in LOADED)
_BOTH = f"WITH g AS ({_REGISTRY_SQL}), n AS ({_COUNTS_SQL})"

check("registry", f"{_BOTH} SELECT g.*, row_count FROM g LEFT JOIN n USING (source_view)")(
    lambda s, d: _registry(s).drop("created_at").join(_source_counts(s, d), ["source_schema", "source_view"], "left")
)
check(
    "registry_health",
    f"""{_BOTH} SELECT load_strategy, is_active, COUNT(*) AS view_count,
        string_agg(source_schema || '.' || source_view, ', ' ORDER BY source_schema || '.' || source_view) AS views,
        CAST(COALESCE(SUM(row_count), 0) AS BIGINT) AS row_count FROM g LEFT JOIN n USING (source_view) GROUP BY 1, 2""",
)(lambda s, d: monitor.registry_health(_registry(s), _source_counts(s, d)))
check(
    "inactive_views",
    f"""{_BOTH} SELECT source_schema, source_view, load_strategy, watermark_column, is_active, row_count
        FROM g JOIN n USING (source_view) WHERE NOT is_active""",
)(lambda s, d: monitor.inactive_views(_registry(s)).join(_source_counts(s, d), ["source_schema", "source_view"]))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "run_log")


check(
    "load_log_write",
    f"""WITH x AS ({_expected_runs()}), d AS (
        SELECT run_id, source AS source_table, source || '_archive' AS target_table, UPPER(status) AS status,
            CASE WHEN status = 'skipped' THEN 'FULL_COMPARE' ELSE strategy END AS load_strategy, rows_inserted, rows_updated FROM x
        UNION ALL SELECT run_id, 'ALL_VIEWS', 'ALL_ARCHIVES', 'PARTIAL_FAILURE', 'SUMMARY', SUM(rows_inserted), SUM(rows_updated) FROM x GROUP BY run_id)
        SELECT CAST(run_id AS BIGINT) AS run_id, source_table, target_table, status, load_strategy,
            CAST(rows_inserted AS BIGINT) AS rows_inserted, CAST(rows_updated AS BIGINT) AS rows_updated,
            CASE run_id WHEN 1 THEN {T1} ELSE {T2} END AS load_timestamp FROM d""",
)(
    lambda s, d: control.load_log(lab(s, d).pipeline()[0]).select(
        "run_id", "source_table", "target_table", "status", "load_strategy", "rows_inserted", "rows_updated", "load_timestamp"
    )
)

_NEW = "ORDER BY load_timestamp DESC, log_id DESC"
check(
    "vw_load_history",
    f"""SELECT log_id, load_timestamp, source_table, target_table, rows_updated, rows_inserted, status, duration_seconds, error_message
        FROM run_log {_NEW} LIMIT 100""",
)(lambda s, d: monitor.load_history(_log(s, d)))
check(
    "last_load",
    f"SELECT load_timestamp AS last_load_time, rows_updated, rows_inserted, status, duration_seconds FROM run_log {_NEW} LIMIT 1",
)(lambda s, d: monitor.last_load(_log(s, d)))
check(
    "load_log_recent",
    f"""SELECT source_table, target_table, load_strategy, status, rows_inserted, rows_updated, duration_seconds, load_timestamp
        FROM run_log {_NEW} LIMIT 50""",
)(lambda s, d: monitor.load_log_recent(_log(s, d)))
check(
    "load_summary_by_run",
    """SELECT date_trunc('hour', load_timestamp)::TIMESTAMP AS run_hour, run_id, COUNT(*) AS views_processed,
           CAST(SUM(CASE WHEN UPPER(status) = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
           CAST(SUM(CASE WHEN UPPER(status) <> 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS failures,
           CAST(SUM(rows_inserted) AS BIGINT) AS total_inserted, CAST(SUM(rows_updated) AS BIGINT) AS total_updated,
           ROUND(SUM(duration_seconds), 0) AS total_duration_sec,
           CAST(ROUND(CAST(AVG(duration_seconds) AS DECIMAL(30, 12)), 2) AS DOUBLE) AS avg_duration_sec
       FROM run_log WHERE load_strategy <> 'SUMMARY' GROUP BY 1, 2 ORDER BY run_hour DESC, run_id DESC LIMIT 20""",
)(lambda s, d: monitor.load_summary_by_run(_log(s, d)))
check(
    "failed_loads",
    f"""SELECT source_table, target_table, load_strategy, status, error_message, load_timestamp, duration_seconds FROM run_log
        WHERE load_strategy <> 'SUMMARY' AND UPPER(status) <> 'SUCCESS' AND load_timestamp >= TIMESTAMP '{ASOF_ORDERS}' - INTERVAL 7 DAY""",
)(lambda s, d: monitor.failed_loads(_log(s, d), ASOF_ORDERS))
check(
    "run_failures_latest",
    """SELECT * FROM run_log WHERE run_id = (SELECT MAX(run_id) FROM run_log) AND load_strategy <> 'SUMMARY'
       AND UPPER(status) <> 'SUCCESS'""",
)(lambda s, d: monitor.run_failures_latest(_log(s, d)))

_MARKS = " UNION ALL ".join(
    f"SELECT 'usage' AS source_schema, '{e.source_view}' AS source_view, CAST(MAX({e.watermark_column}) AS TIMESTAMP) AS last_watermark_value, "
    f"{T2} AS last_loaded_at, '{e.load_strategy}' AS load_strategy, '{e.watermark_column}' AS watermark_column, TRUE AS is_active FROM {e.source_view}"
    for e in REGISTRY
    if e.is_active and e.watermark_column and e.source_view in SOURCES
)
check("watermark_status", _MARKS)(
    lambda s, d: monitor.watermark_status(control.watermark_state(lab(s, d).pipeline()[0]), _registry(s)).drop(
        "last_watermark", "watermark_type"
    )
)

_ACTIVE = [e.source_view for e in REGISTRY if e.is_active and e.source_view in SOURCES]
_EXTRA = {"users": "user_id % 10 = 3", "table_storage": "id % 10 = 3", "grants_to_users": "granted_by = 'G3'"}
_VERSION_COUNTS = " UNION ALL ".join(
    f"SELECT '{n}_archive' AS table_name, COUNT(*) + COUNT(*) FILTER ({_EXTRA.get(n, 'FALSE')}) AS row_count FROM {n}" for n in _ACTIVE
)
check("row_count_union", f"{_VERSION_COUNTS}")(
    lambda s, d: monitor.row_count_union(
        {f"{n}_archive": lab(s, d).pipeline()[0].archive("usage", n).read() for n in _ACTIVE}
    )
)
check(
    "vw_archive_inventory",
    f"""WITH n AS ({_VERSION_COUNTS}) SELECT 'usage' AS source_schema, table_name, row_count, TRUE AS has_bytes,
            {T1} AS created_at, {T2} AS last_modified FROM n""",
)(
    lambda s, d: monitor.archive_inventory(lab(s, d).pipeline()[0])
    .filter("source_schema = 'usage'")
    .withColumn("has_bytes", F.col("bytes") > 0)
    .drop("bytes")
)
check(
    "vw_archive_summary",
    f"""WITH n AS ({_VERSION_COUNTS}) SELECT 'usage' AS source_schema, COUNT(*) AS table_count,
            CAST(SUM(row_count) AS BIGINT) AS total_rows, {T2} AS last_update FROM n""",
)(
    lambda s, d: monitor.archive_summary(
        monitor.archive_inventory(lab(s, d).pipeline()[0]).filter("source_schema = 'usage'")
    ).drop("total_bytes")
)
check(
    "view_discovery_summary",
    """SELECT p_brand AS schema_name, COUNT(*) AS total_views, COUNT(*) FILTER (p_partkey % 3 <> 0) AS archived_views,
           COUNT(*) FILTER (p_partkey % 3 = 0) AS pending_views FROM part GROUP BY 1""",
)(
    lambda s, d: monitor.view_discovery_summary(
        table(s, d, "part").selectExpr("p_brand AS schema_name", "'v' || p_partkey AS view_name"),
        table(s, d, "part")
        .filter("p_partkey % 3 <> 0")
        .selectExpr("p_brand AS schema_name", "'v' || p_partkey || '_archive' AS table_name"),
    )
)


@check(
    "sql_on_archives",
    """SELECT default_role, COUNT(*) AS users, COUNT(*) FILTER (has_mfa) AS mfa_users FROM users GROUP BY 1""",
)
def _sql_on_archives(spark, sf_dir):
    """The archives of a store under their names in Spark SQL."""
    lab(spark, sf_dir).pipeline()[0].register_views()
    return spark.sql(
        """SELECT default_role, COUNT(*) AS users, COUNT(CASE WHEN has_mfa THEN 1 END) AS mfa_users
           FROM usage_users_archive WHERE _is_current GROUP BY default_role"""
    )
