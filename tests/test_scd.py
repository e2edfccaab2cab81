from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yearring.operators import scd, temporal
from yearring.operators.compaction import cluster_archive, vacuum
from yearring.operators.ids import write_numbered
from yearring.sources import store as storage
from yearring.sources.store import ENDS, ArchiveStore

TIMES = [f"2024-01-{d:02d} 00:00:00" for d in range(1, 20)]


def frame(spark, rows):
    return spark.createDataFrame([(k, v) for k, v in rows], "k int, v string")


def rows(df):
    return Counter((r["k"], r["v"]) for r in df.select("k", "v").collect())


def load(archive, df, i, **kw):
    result = scd.load_view(archive, df, TIMES[i], **kw)
    assert result.status == "success", result.error
    return result


def check_invariants(archive):
    df = archive.read()
    bad = df.filter(
        (F.col("_is_current") != (F.col("_valid_to") == F.lit(scd.OPEN_END).cast("timestamp_ntz")))
        | (F.col("_valid_from") >= F.col("_valid_to"))
        | (F.col("_valid_from") != F.col("_loaded_at"))
    )
    assert bad.count() == 0
    m = archive.manifest()
    ids = df.agg(F.count("*").alias("n"), F.countDistinct("_archive_id").alias("d"), F.max("_archive_id").alias("x")).first()
    assert ids["n"] == ids["d"] == m.max_id == m.rows() and ids["x"] in (m.max_id, None)
    assert archive.read("open").filter("NOT _is_current").count() == 0
    assert archive.read("closed").filter("_is_current").count() == 0
    assert temporal.verify_hash(df).filter("mismatches > 0").count() == 0
    assert df.columns[:8] == list(scd.HISTORY_COLUMNS)


def test_change_delete_and_return(spark, store):
    a = store.archive("s", "v")
    load(a, frame(spark, [(1, "a"), (2, "b"), (3, "c")]), 0)
    r = load(a, frame(spark, [(1, "a2"), (2, "b")]), 1)
    assert (r.rows_inserted, r.rows_updated) == (1, 2)
    r = load(a, frame(spark, [(1, "a"), (2, "b"), (3, "c")]), 2)
    assert (r.rows_inserted, r.rows_updated) == (2, 1)
    check_invariants(a)
    assert rows(temporal.as_of(a.read(), TIMES[1])) == Counter([(1, "a2"), (2, "b")])
    gone = load(a, frame(spark, []), 3)
    assert (gone.rows_inserted, gone.rows_updated) == (0, 3)
    assert a.read("open").count() == 0
    assert {r["k"] for r in temporal.deleted_records(a.read("closed"), a.read("open"), ["k"]).collect()} == {1, 2, 3}
    check_invariants(a)


def test_replaying_a_snapshot_changes_nothing(spark, store):
    a = store.archive("s", "v")
    s = frame(spark, [(i, str(i % 3)) for i in range(50)])
    load(a, s, 0)
    before = a.manifest().parts
    r = load(a, s.orderBy(F.desc("k")), 1)
    assert (r.rows_inserted, r.rows_updated) == (0, 0)
    assert a.manifest().parts == before


def test_no_stored_row_is_rewritten(spark, store):
    a = store.archive("s", "v")
    load(a, frame(spark, [(1, "a"), (2, "b")]), 0)
    load(a, frame(spark, [(1, "a"), (2, "b"), (3, "c"), (4, "d")]), 1)
    before = a.manifest().parts
    load(a, frame(spark, [(1, "a"), (2, "b"), (4, "d")]), 2)
    after = a.manifest().parts
    assert after[: len(before)] == before
    (ends,) = after[len(before) :]
    assert (ends.state, ends.rows, ends.ends) == (ENDS, 1, 1)
    assert rows(a.read("open")) == Counter([(1, "a"), (2, "b"), (4, "d")])
    check_invariants(a)


def test_rows_that_come_back_have_an_end_for_each_stay(spark, store):
    """The same times and hashes again and again: ids tell the stays apart."""
    a = store.archive("s", "v")
    stays = [[(1, "a")] * 3 + [(2, "b")], [(2, "b")], [(1, "a")] * 2, [], [(1, "a"), (2, "b")], []]
    for i, snapshot in enumerate(stays):
        load(a, frame(spark, snapshot), i)
        check_invariants(a)
    for i, snapshot in enumerate(stays):
        assert rows(temporal.as_of(a.read(), TIMES[i])) == Counter(snapshot)
    assert a.manifest().rows("closed") == 8 and a.read("open").count() == 0
    b = store.archive("s", "same_time")
    for snapshot in stays:
        load(b, frame(spark, snapshot), 0)
        assert rows(b.read("open")) == Counter(snapshot)


def test_clustering_folds_ends_in(spark, store, monkeypatch):
    a = store.archive("s", "v")
    load(a, frame(spark, [(i, "a") for i in range(40)] + [(0, "a")] * 5), 0)
    load(a, frame(spark, [(i, "a") for i in range(20, 50)]), 1)
    load(a, frame(spark, [(i, "a") for i in range(10, 30)]), 2)
    before = sorted(map(str, a.read().collect()))
    monkeypatch.setattr(storage, "BROADCAST_ENDS", 0)
    assert sorted(map(str, a.read().collect())) == before
    m = cluster_archive(a, TIMES[3])
    assert {p.state for p in m.parts} == {"open", "closed"} and m.ends() == 0
    assert sorted(map(str, a.read().collect())) == before
    load(a, frame(spark, [(i, "a") for i in range(15, 25)]), 4)
    check_invariants(a)
    before = sorted(map(str, a.read().collect()))
    cluster_archive(a, TIMES[5])
    assert sorted(map(str, a.read().collect())) == before
    check_invariants(a)


def test_new_rows_with_the_same_json_but_other_raw_forms(spark, store, tmp_path):
    """Maps in another order and both zeros: one hash, several probes."""
    path = str(tmp_path / "in")
    rows_of = "SELECT id AS k, IF(id % 2 = 0, 0D, -0D) AS z, IF(id % 2 = 0, map('a', 1, 'b', 2), map('b', 2, 'a', 1)) AS m, array(IF(id % 2 = 0, 0D, -0D)) AS l FROM range({n})"
    spark.sql(rows_of.format(n=4)).drop("k").write.parquet(path)
    a = store.archive("s", "v")
    load(a, spark.read.parquet(path).filter("false"), 0, plain=True)
    assert load(a, spark.read.parquet(path), 1, plain=True).rows_inserted == 4
    spark.sql(rows_of.format(n=6)).write.parquet(path + "2")
    b = store.archive("s", "maps")
    load(b, spark.read.parquet(path + "2").filter("k < 2"), 0, plain=True)
    assert load(b, spark.read.parquet(path + "2"), 1, plain=True).rows_inserted == 4
    check_invariants(b)


def test_a_source_that_changes_under_the_load_is_refused(spark, store, tmp_path, monkeypatch):
    """The copies of new rows are counted too: one lost copy and one extra copy don't pass for each other."""
    path = str(tmp_path / "in")
    spark.range(20).selectExpr("id AS k", "'a' AS v").write.parquet(path)
    a = store.archive("s", "v")
    load(a, spark.read.parquet(path), 0, plain=True)
    spark.range(30).selectExpr("IF(id < 25, id, 25) AS k", "'b' AS v").write.parquet(path + "2")
    source, new_rows = spark.read.parquet(path + "2"), scd._new_rows

    def change(*args):
        spark.range(30).selectExpr("IF(id < 26, id, 26) AS k", "'b' AS v").write.mode("overwrite").parquet(path + "2")
        source._jdf.sparkSession().catalog().refreshByPath(path + "2")
        return new_rows(*args)

    monkeypatch.setattr(scd, "_new_rows", change)
    assert scd.load_view(a, source, TIMES[1], plain=True).status == "error"
    assert a.read("open").count() == 20


def test_duplicates_are_all_kept_and_a_lost_copy_is_not_seen(spark, store):
    a = store.archive("s", "v")
    load(a, frame(spark, [(1, "a")] * 3 + [(2, "b")]), 0)
    r = load(a, frame(spark, [(1, "a"), (2, "b")]), 1)
    assert (r.rows_inserted, r.rows_updated) == (0, 0)
    assert temporal.duplicate_current(a.read()).first()["dupes"] == 4
    r = load(a, frame(spark, [(2, "b")]), 2)
    assert r.rows_updated == 3
    check_invariants(a)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("xyz")), max_size=8, unique=True), min_size=2, max_size=4))
def test_every_snapshot_can_be_read_back(spark, tmp_path_factory, history):
    store = ArchiveStore(spark, str(tmp_path_factory.mktemp("h")))
    a = store.archive("s", "v")
    for i, snapshot in enumerate(history):
        load(a, frame(spark, snapshot), i)
    check_invariants(a)
    for i, snapshot in enumerate(history):
        assert rows(temporal.as_of(a.read(), TIMES[i])) == Counter(snapshot)


def test_large_differences_give_the_same_result_without_broadcast(spark, store, monkeypatch):
    monkeypatch.setattr(scd, "BROADCAST_HASHES", 0)
    monkeypatch.setattr(storage, "BROADCAST_ENDS", 0)
    a = store.archive("s", "v")
    load(a, frame(spark, [(i, "x") for i in range(200)] + [(0, "x")] * 100), 0)
    r = load(a, frame(spark, [(i, "y" if i % 2 else "x") for i in range(1, 250)]), 1)
    assert (r.rows_inserted, r.rows_updated) == (125 + 24 + 1, 100 + 101)
    check_invariants(a)


def stream(spark, pairs):
    return spark.createDataFrame(pairs, "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("t"))


def test_append_only_takes_rows_past_the_watermark(spark, store, tmp_path):
    a = store.archive("s", "v")
    options = {"strategy": scd.APPEND_ONLY, "watermark_column": "t"}
    load(a, stream(spark, [(1, "2024-01-01 00:00:00.5"), (2, None)]), 0, **options)
    assert a.manifest().watermark == "2024-01-01 00:00:00.5"
    late_null_tie_new = [(3, "2023-12-31"), (4, None), (5, "2024-01-01 00:00:00.5"), (6, "2024-01-01 00:00:00.500001")]
    r = load(a, stream(spark, late_null_tie_new), 1, **options)
    assert r.rows_inserted == 1 and {x["k"] for x in a.read().collect()} == {1, 2, 6}
    r = load(a, stream(spark, []), 2, **options)
    assert r.rows_inserted == 0 and a.manifest().watermark == "2024-01-01 00:00:00.500001"


@pytest.mark.parametrize("told,closed", [(False, 0), (True, 1)])
def test_append_only_without_a_watermark_closes_only_when_told(spark, store, told, closed):
    a = store.archive("s", "v")
    options = {"strategy": scd.APPEND_ONLY, "watermark_column": "t"}
    load(a, stream(spark, [(1, None), (3, None)]), 0, **options)
    r = load(a, stream(spark, [(2, "2024-01-02"), (3, None)]), 1, close_unmarked=told, **options)
    assert (r.rows_inserted, r.rows_updated) == (1, closed)
    assert a.manifest().watermark == "2024-01-02 00:00:00"


@pytest.mark.parametrize("kind,low,high", [("date", "2024-01-01", "2024-01-09"), ("timestamp", "2024-03-10 06:59:59.9", "2024-03-10 07:00:00.1"), ("bigint", "9", "10")])
def test_watermark_types(spark, store, kind, low, high):
    a = store.archive("s", kind)
    df = spark.createDataFrame([(1, low), (2, high)], "k int, w string").select("k", F.col("w").cast(kind).alias("w"))
    options = {"strategy": scd.APPEND_ONLY, "watermark_column": "w"}
    load(a, df.filter("k = 1"), 0, **options)
    assert load(a, df, 1, **options).rows_inserted == 1
    assert load(a, df, 2, **options).rows_inserted == 0
    assert a.read().count() == 2


def test_new_lost_and_wider_columns(spark, store):
    a = store.archive("s", "v")
    base = spark.sql("SELECT id AS k, CAST(id AS INT) AS n, CAST(id AS FLOAT) AS f, 'x' AS old FROM range(4)")
    load(a, base, 0)
    wider = spark.sql("SELECT id AS k, id AS n, CAST(id AS DOUBLE) AS f, 'x' AS old, CAST(NULL AS STRING) AS new FROM range(4)")
    r = load(a, wider, 1)
    assert (r.rows_inserted, r.rows_updated) == (0, 0)
    types = dict(a.read().dtypes)
    assert (types["n"], types["f"], types["new"]) == ("bigint", "double", "string")
    lost = wider.drop("old").withColumn("new", F.when(F.col("k") == 1, "v"))
    r = load(a, lost, 2)
    assert (r.rows_inserted, r.rows_updated) == (4, 4)
    assert a.read("open").filter("old IS NOT NULL").count() == 0
    assert a.read("closed").filter("old = 'x'").count() == 4
    assert a.read().columns[-1] == "new"
    check_invariants(a)


def test_a_crash_before_the_commit_leaves_the_old_state(spark, store, monkeypatch):
    a = store.archive("s", "v")
    load(a, frame(spark, [(1, "a"), (2, "b")]), 0)

    def crash(self, manifest):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(type(a), "commit", crash)
        r = scd.load_view(a, frame(spark, [(1, "z")]), TIMES[1])
        assert r.status == "error" and "lost the driver" in r.error
    assert rows(a.read()) == Counter([(1, "a"), (2, "b")])
    r = load(a, frame(spark, [(1, "z")]), 2)
    assert (r.rows_inserted, r.rows_updated) == (1, 2)
    check_invariants(a)


def test_two_writers_cannot_both_commit(spark, store):
    a = store.archive("s", "v")
    load(a, frame(spark, [(1, "a")]), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        a.commit(a.manifest())


def test_the_winners_rows_survive_the_loser(spark, store, monkeypatch):
    """Two real writers of the same version: the second fails, and has touched nothing of the first."""
    a, b = store.archive("s", "v"), store.archive("s", "v")
    load(a, frame(spark, [(1, "a")]), 0)
    old = b.manifest()
    load(a, frame(spark, [(1, "a")] + [(i, "won") for i in range(2, 12)]), 1)
    monkeypatch.setattr(b, "manifest", lambda: old)
    r = scd.load_view(b, frame(spark, [(1, "a")] + [(i, "lost") for i in range(2, 7)]), TIMES[2])
    assert r.status == "error" and "another writer" in r.error
    assert rows(a.read()) == Counter([(1, "a")] + [(i, "won") for i in range(2, 12)])
    assert a.fs.names(f"{a.path}/staging") == []
    check_invariants(a)


def test_error_texts_are_whole(spark, store, monkeypatch):
    def fail(*args):
        raise RuntimeError("x" * 10_000)

    monkeypatch.setattr(scd, "load_initial", fail)
    assert len(scd.load_view(store.archive("s", "v"), frame(spark, [(1, "a")]), TIMES[0]).error) == 10_000


def test_a_store_below_a_folder_that_looks_like_a_part(spark, tmp_path):
    a = ArchiveStore(spark, str(tmp_path / "data" / "run=7" / "x y")).archive("s", "v")
    load(a, frame(spark, [(1, "a"), (2, "b")]), 0)
    assert load(a, frame(spark, [(1, "a")]), 1).rows_updated == 1
    check_invariants(a)


def test_decimals_grow_without_losing_digits(spark, store):
    a = store.archive("s", "v")
    load(a, spark.sql("SELECT 1 AS k, CAST(1.50 AS DECIMAL(10, 2)) AS d UNION ALL SELECT 2, 2.25"), 0)
    r = load(a, spark.sql("SELECT 1 AS k, CAST(1.5 AS DECIMAL(12, 4)) AS d UNION ALL SELECT 2, 1.2567"), 1)
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    assert dict(a.read().dtypes)["d"] == "decimal(12,4)"
    assert {str(x["d"]) for x in a.read("open").collect()} == {"1.5000", "1.2567"}
    r = load(a, spark.sql("SELECT 1 AS k, CAST(1.5 AS DECIMAL(3, 1)) AS d"), 2)
    assert (r.rows_inserted, r.rows_updated) == (0, 1)
    check_invariants(a)


def test_floats_and_dates_verify_after_growth(spark, store):
    a = store.archive("s", "v")
    load(a, spark.sql("SELECT id AS k, CAST(0.1 AS FLOAT) AS f, DATE '2024-01-01' AS d FROM range(3)"), 0)
    r = load(a, spark.sql("SELECT id AS k, CAST(CAST(0.1 AS FLOAT) AS DOUBLE) AS f, TIMESTAMP_NTZ '2024-01-01' AS d FROM range(3)"), 1)
    assert (r.rows_inserted, r.rows_updated) == (0, 0)
    check_invariants(a)


def test_nested_growth_and_letter_case(spark, store):
    a = store.archive("s", "v")
    load(a, spark.sql("SELECT id AS k, named_struct('a', id) AS n, array(named_struct('x', 1)) AS l FROM range(3)"), 0)
    grown = "SELECT id AS K, named_struct('b', IF(id = 1, 'new', NULL), 'A', id) AS N, array(named_struct('x', 1, 'y', CAST(NULL AS INT))) AS l FROM range(3)"
    r = load(a, spark.sql(grown), 1)
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    assert dict(a.read().dtypes)["n"] == "struct<a:bigint,b:string>" and dict(a.read().dtypes)["l"] == "array<struct<x:int,y:int>>"
    assert [tuple(x) for x in a.read("open").filter("k = 1").select("n.a", "n.b").collect()] == [(1, "new")]
    check_invariants(a)


@pytest.mark.parametrize("first,second", [("bigint", "double"), ("int", "string"), ("decimal(38,0)", "decimal(38,10)"), ("struct<a:bigint>", "struct<a:string>")])
def test_types_that_do_not_fit_are_refused(spark, store, first, second):
    a = store.archive("s", first)
    make = lambda kind: spark.createDataFrame([], f"k int, c {kind}")
    load(a, make(first), 0)
    r = scd.load_view(a, make(second), TIMES[1])
    assert r.status == "error" and "does not fit" in r.error
    assert a.manifest().version == 1


def test_missing_source_is_skipped(store):
    r = scd.load_view(store.archive("s", "v"), None, TIMES[0])
    assert r.status == "skipped" and store.archive("s", "v").manifest() is None


def test_ids_are_dense_over_many_partitions(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=13).withColumn("v", F.col("id") % 7)
    df.write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in")).filter("v <> 3")
    written = write_numbered(source, str(tmp_path / "out"), "n", 500)
    got = sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == list(range(501, 501 + written.rows))


def test_clustering_keeps_every_version(spark, store):
    a = store.archive("s", "v")
    for i, s in enumerate(([(1, "a"), (2, "b")], [(1, "c"), (3, "d")], [(3, "d")])):
        load(a, frame(spark, s), i)
    before = sorted(map(str, a.read().collect()))
    m = cluster_archive(a, TIMES[4], files=2)
    assert sorted(map(str, a.read().collect())) == before and len(m.parts) == 2 and not m.ends()
    r = load(a, frame(spark, [(4, "e")]), 5)
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    check_invariants(a)


def test_as_of_accepts_a_null_end(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01' AS _valid_from, CAST(NULL AS TIMESTAMP_NTZ) AS _valid_to")
    assert temporal.as_of(df, "2024-01-01 00:00:00").count() == 1
    assert temporal.as_of(df, "2023-12-31 23:59:59").count() == 0


def test_an_unchanged_plain_source_is_not_copied(spark, store, tmp_path, monkeypatch):
    """Only hashes are staged when nothing changed; with changes, only the changed rows."""
    path = str(tmp_path / "in")
    spark.range(500).selectExpr("id AS k", "CAST(id AS STRING) AS v").write.parquet(path)
    a, staged = store.archive("s", "v"), []
    stage = scd.stage_source
    monkeypatch.setattr(scd, "stage_source", lambda df, where: staged.append((where.rsplit("/", 1)[1], df.columns)) or stage(df, where))
    load(a, spark.read.parquet(path), 0, plain=True)
    load(a, spark.read.parquet(path), 1, plain=True)
    assert staged == [("difference", ["h", "here", "there", "after", "probe"])]
    spark.range(500).selectExpr("id AS k", "IF(id < 5, 'new', CAST(id AS STRING)) AS v").write.parquet(path + "2")
    r = load(a, spark.read.parquet(path + "2"), 2, plain=True)
    assert (r.rows_inserted, r.rows_updated) == (5, 5)
    assert [name for name, _ in staged] == ["difference", "difference", "fresh"]
    check_invariants(a)


def test_clustering_takes_only_new_parts_and_sizes_files(spark, store):
    a = store.archive("s", "v")
    load(a, frame(spark, [(i, "a") for i in range(300)]), 0)
    first = cluster_archive(a, TIMES[1], file_bytes=1500)
    (old,) = first.parts
    assert old.clustered and len(a.fs.sizes(f"{a.path}/{old.dir}")) > 1
    load(a, frame(spark, [(i, "a") for i in range(400)]), 2)
    second = cluster_archive(a, TIMES[3])
    assert old in second.parts and len(second.parts) == 2
    assert cluster_archive(a, TIMES[4]).parts == second.parts
    load(a, frame(spark, [(i, "a") for i in range(1, 400)]), 5)
    cluster_archive(a, TIMES[6])
    check_invariants(a)


def test_vacuum_keeps_what_manifests_name(spark, store):
    a = store.archive("s", "v")
    for i, s in enumerate(([(1, "a"), (2, "b")], [(1, "c"), (2, "b"), (3, "d")], [(3, "d")])):
        load(a, frame(spark, s), i)
    a.fs.write_new(f"{a.path}/staging/run=2-lost/part", "x")
    a.fs.write_new(f"{a.path}/data/run=99-underway/part", "x")
    before, two_back = sorted(map(str, a.read().collect())), a.manifest().version - 1
    assert vacuum(a, keep_versions=2) > 0
    assert sorted(map(str, a.read().collect())) == before
    names = a.fs.names(f"{a.path}/_log")
    assert len(names) == 2 and a.fs.names(f"{a.path}/staging") == []
    cluster_archive(a, TIMES[4])
    vacuum(a)
    assert sorted(map(str, a.read().collect())) == before
    assert len(a.fs.names(f"{a.path}/_log")) == 1 and two_back
    kept = {p.dir.split("/")[1] for p in a.manifest().parts}
    assert set(a.fs.names(f"{a.path}/data")) == kept | {"run=99-underway"}
    assert vacuum(a) == 0
    load(a, frame(spark, [(9, "z")]), 5)
    check_invariants(a)
    with pytest.raises(ValueError):
        vacuum(a, keep_versions=0)
