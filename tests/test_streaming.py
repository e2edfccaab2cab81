from __future__ import annotations

from pyspark.sql import functions as F

from yearring.operators import scd
from yearring.streaming import append


def events(spark, lo, hi):
    return spark.sql(f"SELECT id, TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS t FROM range({lo}, {hi})")


def test_a_replayed_batch_is_stored_once(spark, store):
    a = store.archive("s", "v")
    assert append.append_batch(a, events(spark, 0, 5), 0, "2024-02-01 00:00:00") == 5
    assert append.append_batch(a, events(spark, 0, 5), 0, "2024-02-01 00:00:00") == 0
    assert append.append_batch(a, events(spark, 5, 8), 1, "2024-02-01 00:00:00") == 3
    got = a.read().agg(F.count("*").alias("n"), F.countDistinct("_archive_id").alias("d"), F.max("_archive_id").alias("x")).first()
    assert tuple(got) == (8, 8, 8)


def test_restarts_and_repeats(spark, store, tmp_path):
    a, path = store.archive("s", "v"), str(tmp_path / "in")
    for lo, hi in ((0, 10), (5, 15), (15, 20)):
        rows = events(spark, lo, hi)
        rows.write.mode("append").parquet(path)
        source = append.file_stream(spark, path, rows.schema)
        append.stream_append_late(source, a, str(tmp_path / "checkpoint"), "2024-02-01 00:00:00", "t", "2 days").awaitTermination()
    assert sorted(r["id"] for r in a.read().collect()) == list(range(20))


def test_every_checkpoint_is_a_stream_of_its_own(spark, store, tmp_path):
    """Batch numbers start anew with a new checkpoint; nothing may be taken for a replay."""
    a = store.archive("s", "v")
    for n, (lo, hi) in enumerate(((0, 3), (3, 6), (6, 56))):
        path = str(tmp_path / f"in{n}")
        rows = events(spark, lo, hi)
        rows.write.parquet(path)
        for _ in range(2):  # the second start finds nothing new
            append.stream_append_only(append.file_stream(spark, path, rows.schema), a, str(tmp_path / f"c{n}"), "2024-02-01 00:00:00").awaitTermination()
    assert sorted(r["id"] for r in a.read().collect()) == list(range(56))


def test_a_batch_load_goes_on_from_the_stream(spark, store, tmp_path):
    a, path = store.archive("s", "v"), str(tmp_path / "in")
    rows = events(spark, 0, 6)
    rows.write.parquet(path)
    append.stream_append_only(append.file_stream(spark, path, rows.schema), a, str(tmp_path / "c"), "2024-02-01 00:00:00", "t").awaitTermination()
    assert a.manifest().watermark == "2024-01-01 05:00:00"
    r = scd.load_view(a, events(spark, 4, 9), "2024-02-02 00:00:00", scd.APPEND_ONLY, "t")
    assert (r.rows_inserted, r.rows_updated) == (3, 0)
    # A late batch does not move the watermark back.
    append.append_batch(a, events(spark, -3, 0), 9, "2024-02-03 00:00:00", watermark_column="t")
    assert a.manifest().watermark == "2024-01-01 08:00:00"
    assert sorted(x["id"] for x in a.read("open").collect()) == list(range(-3, 9))
