from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from yearring.operators.compaction import cluster_archive
from yearring.operators.lookup import PUSHED, key_lookup
from yearring.operators.scd import load_view

ROWS = 20_000


def users(spark, kind="string", change=0):
    """Even keys in no order, so that ranges of row groups exclude nothing."""
    key = F.shiftleft(F.xxhash64("id"), 1).cast(kind)
    return spark.range(0, ROWS, 1, 4).select(key.alias("user"), (F.col("id") + change * (F.col("id") % 1000 == 0).cast("long")).alias("v"))


def scanned(df):
    """Rows that the Parquet scans of the open versions put out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_row_groups_without_the_key_are_skipped(spark, store, kind):
    a, b = store.archive("s", f"with_{kind}"), store.archive("s", f"without_{kind}")
    for archive, key in ((a, "user"), (b, None)):
        assert load_view(archive, users(spark, kind), "2024-02-01 00:00:00", plain=True, key=key).status == "success"
    some = users(spark, kind).filter("v = 777").first()["user"]
    absent = str(int(some) + 1) if kind == "string" else some + 1
    assert scanned(key_lookup(a, [absent])) == 0
    assert scanned(b.read().filter(F.col("user") == absent)) == ROWS
    assert scanned(a.read().filter(F.col("user") == absent)) == 0
    found = key_lookup(a, [some, absent, None, some])
    assert [(r["user"], r["v"]) for r in found.collect()] == [(some, 777)]
    assert 0 < scanned(found) <= ROWS // 2
    cluster_archive(a, "2024-02-02 00:00:00", files=4)
    assert a.manifest().key == "user"
    assert scanned(key_lookup(a, [absent])) == 0
    assert key_lookup(a, [some]).count() == 1


def test_later_loads_keep_the_key(spark, store):
    a = store.archive("s", "v")
    load_view(a, users(spark), "2024-02-01 00:00:00", plain=True, key="user")
    load_view(a, users(spark, change=1), "2024-02-02 00:00:00", plain=True)
    some = users(spark).filter("v = 3000").first()["user"]
    got = sorted((r["v"], r["_is_current"]) for r in key_lookup(a, [some]).collect())
    assert got == [(3000, False), (3001, True)]
    assert [r["v"] for r in key_lookup(a, [some], "open").collect()] == [3001]
    assert [r["v"] for r in key_lookup(a, [some], "closed").collect()] == [3000]


def test_many_keys_are_joined(spark, store):
    a = store.archive("s", "v")
    load_view(a, users(spark), "2024-02-01 00:00:00", plain=True, key="user")
    keys = users(spark).filter(f"v <= {2 * PUSHED}").select("user")
    more = keys.union(keys).union(spark.createDataFrame([(None,)], "user string"))
    assert sorted(r["v"] for r in key_lookup(a, more).collect()) == list(range(2 * PUSHED + 1))
    assert key_lookup(a, [r["user"] for r in keys.collect()]).count() == 2 * PUSHED + 1
    assert key_lookup(a, keys.limit(0)).count() == 0 and key_lookup(a, []).count() == 0


def test_a_key_has_to_be_there(spark, store):
    a = store.archive("s", "v")
    assert "no key column" in load_view(a, users(spark), "2024-02-01 00:00:00", key="other").error
    load_view(a, users(spark), "2024-02-01 00:00:00", plain=True)
    with pytest.raises(ValueError, match="named a key"):
        key_lookup(a, ["1"])
