"""Plans that must hold at a thousand times the data."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.fixtures import derive
from checks.lab import lab
from yearring.operators import scd, sieve, temporal
from yearring.operators.rollup import Rollup, RollupStore
from yearring.plans import performance, security
from yearring.sources import store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_delta_scan_pushes_the_watermark(spark, sf):
    text = formatted(scd.scan_delta(derive(spark, sf, "query_history"), "start_time", "2024-01-21 00:00:00"))
    assert "GreaterThan(ts,2024-01-21T00:00" in text


def test_reports_read_few_columns(spark, sf):
    text = formatted(performance.query_type_distribution(lab(spark, sf).read("query_history")))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"_is_current", "query_type", "total_elapsed_time"}
    assert "TakeOrderedAndProject" in text


def test_hash_difference_moves_only_hashes(spark, sf):
    archive = lab(spark, sf).archive("users")
    source = scd.with_hash(derive(spark, sf, "users"))
    manifest = archive.manifest()
    text = formatted(scd.hash_difference(source, archive.stored("open", manifest), archive.stored("ends", manifest)))
    assert "ReadSchema: struct<_row_hash:string>" in text and "ReadSchema: struct<h:binary,upto:bigint,copies:bigint>" in text
    assert text.count("Exchange") and "Join" not in text
    assert "partial_sum" in text


def test_ends_are_broadcast_while_few(spark, sf, monkeypatch):
    archive = lab(spark, sf).archive("users")
    assert archive.manifest().ends() > 0
    assert "BroadcastHashJoin" in formatted(archive.read()) and "LeftAnti" in formatted(archive.read("open"))
    monkeypatch.setattr(store, "BROADCAST_ENDS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in formatted(archive.read())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_as_of_filters_reach_the_files(spark, sf):
    text = formatted(temporal.as_of(lab(spark, sf).read("users", None), "2024-02-01 12:00:00"))
    assert "LessThanOrEqual(_valid_from" in text


def test_failed_logins_are_sorted_per_minute_not_per_user(spark, sf):
    text = plan(security.failed_logins_24h(lab(spark, sf).read("login_history")))
    keys = re.findall(r"Window \[.*\], \[([^\]]*)\], \[", text)
    rows, counts = [k for k in keys if "_minute" in k], [k for k in keys if "_minute" not in k]
    assert len(rows) == 1 and len(counts) == 1
    # the one window per user runs over counts per minute
    below = text[text.index("AS _mid") :]
    assert "HashAggregate(keys=[_user" in below and "functions=[partial_count(1)" in below


def test_access_reports_drop_other_queries_before_they_explode(spark, sf):
    here = lab(spark, sf)
    args = (here.read("access_log"), here.read("access_history"), "2001-08-02 00:00:00")
    for report in (performance.policy_access, performance.lineage_modified, performance.user_table_access):
        text = plan(report(*args))
        assert text.index("Join") < text.index("Generate explode") < text.index("LeftSemi")
        # mentions are counted before the join with the queries
        assert "HashAggregate(keys=[query_id" in text[text.index("Join") : text.index("Generate explode")]


def test_access_texts_are_never_sorted(spark, sf, monkeypatch):
    here = lab(spark, sf)
    args = (here.read("access_log"), here.texts().read("open"), "2001-08-02 00:00:00")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (performance.lineage_modified, performance.user_table_access):
            monkeypatch.setattr(performance, "BROADCAST_QUERIES", 1_000_000)
            text = plan(report(*args))
            few = report(*args).collect()
            assert re.search(r"BroadcastHashJoin \[query_id#\d+L\], \[query_id#\d+L\], LeftSemi", text)
            monkeypatch.setattr(performance, "BROADCAST_QUERIES", 0)
            text = plan(report(*args))
            assert re.search(r"ShuffledHashJoin \[query_id#\d+L\], \[query_id#\d+L\], LeftSemi, BuildRight", text)
            assert report(*args).collect() == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_archives_are_written_small(spark, sf):
    """Row hashes are hex text: half of it goes if the parts are entropy coded."""
    archive = lab(spark, sf).archive("warehouse_metering")
    names = [n for p in archive.manifest().parts for n in archive.fs.sizes(f"{archive.path}/{p.dir}")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_many_keys_sift_the_wide_side_before_it_moves(spark, sf, monkeypatch):
    archive = lab(spark, sf).archive("users")
    monkeypatch.setattr(store, "BROADCAST_ENDS", 0)
    monkeypatch.setattr(scd, "BROADCAST_HASHES", 0)
    source = derive(spark, sf, "users")
    hashes = scd.hash_difference(scd.with_hash(source), archive.stored("open", archive.manifest()), probe=scd._probe(source))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = [plan(archive.read("open")), *[plan(scd._new_rows(source, hashes, 5_000_000, p)) for p in (scd._probe(source), None)]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in texts:
        # the bitmap comes between the exchange of the exact join and the scan
        assert text.index("Exchange hashpartitioning") < text.index("BroadcastHashJoin") < text.rindex("FileScan")


def test_the_difference_is_hashed_and_not_sorted(spark, sf):
    archive = lab(spark, sf).archive("users")
    source = derive(spark, sf, "users")
    text = plan(scd.hash_difference(scd.with_hash(source), archive.stored("open", archive.manifest()), None, "last_success_login", scd._probe(source)))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_sieve_misses_no_key_and_lets_few_others_through(spark):
    rows, keys = spark.range(200_000).withColumn("w", F.lit("wide")), spark.range(0, 200_000, 20)
    passed = {r.id for r in sieve.sifted(rows, F.xxhash64("id"), keys, F.xxhash64("id"), 10_000).collect()}
    assert passed >= set(range(0, 200_000, 20)) and len(passed) < 30_000


def test_bits_travel_as_lists(spark, sf):
    rollup = Rollup("bits", ("c_custkey", "c_nationkey"), "c_nationkey", distincts={"people": "c_custkey"})
    archive = lab(spark, sf).store.archive("usage", "bits")
    scd.load_initial(archive, spark.read.parquet(f"{sf}/customer.parquet").select(*rollup.reads), "2024-02-01 06:00:00", plain=True)
    built = RollupStore(archive, rollup)
    built.refresh()
    rows = rollup.keyed(archive.read("open"), value="CAST(c_custkey AS STRING)")
    text = plan(built._bits(rows, "people", 1, 1))
    # bitmaps are made after the last exchange, not for each task before it
    assert text.index("partial_bitmap_construct_agg") < text.index("Exchange")
