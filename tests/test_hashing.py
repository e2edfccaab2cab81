from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from yearring.functions.hashing import row_hash, row_hash_concat


def hashes(df, **kw):
    return [r[0] for r in df.select(row_hash(df.schema, **kw)).collect()]


def one(spark, expr):
    return hashes(spark.sql(f"SELECT {expr}"))[0]


def test_text_form(spark):
    got = one(spark, "2 AS b, 'x' AS a, CAST(NULL AS INT) AS c")
    assert got == hashlib.sha256(b'{"a":"x","b":2}').hexdigest()


def test_column_order_and_empty_columns_do_not_matter(spark):
    assert one(spark, "1 AS a, 'x' AS b") == one(spark, "'x' AS b, 1 AS a, CAST(NULL AS STRING) AS c")


def test_moving_a_value_between_columns_changes_the_hash(spark):
    assert one(spark, "NULL AS a, 'x' AS b") != one(spark, "'x' AS a, NULL AS b")


def test_one_microsecond_changes_the_hash(spark):
    a = one(spark, "TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' AS t")
    assert a != one(spark, "TIMESTAMP_NTZ '2024-01-01 00:00:00.000002' AS t")
    assert one(spark, "TIMESTAMP '2024-01-01 00:00:00.000001 UTC' AS t") != one(
        spark, "TIMESTAMP '2024-01-01 00:00:00.000002 UTC' AS t"
    )


def test_map_order_does_not_matter_at_any_depth(spark):
    a = one(spark, "named_struct('m', array(map('x', 1, 'y', 2))) AS s")
    assert a == one(spark, "named_struct('m', array(map('y', 2, 'x', 1))) AS s")
    assert a != one(spark, "named_struct('m', array(map('y', 1, 'x', 2))) AS s")


def test_concat_variant_skips_nulls(spark):
    df = spark.sql("SELECT 'a' AS x, CAST(NULL AS STRING) AS y, 'b' AS z")
    got = df.select(row_hash_concat(["x", "y", "z"])).first()[0]
    assert got == hashlib.sha256(b"a|b").hexdigest()


def test_session_zone_does_not_matter(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-07-01 12:00:00 UTC' AS t, TIMESTAMP_NTZ '2024-07-01 12:00:00' AS n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    before = hashes(df)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert hashes(df.select(F.col("n"), F.col("t"))) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
