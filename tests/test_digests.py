"""Digest trees: they stay true through loads, and show what was altered or lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from yearring.operators import scd, sidetable
from yearring.operators.compaction import cluster_archive
from yearring.operators.digests import FAN, DigestTree, differing_blocks

BLOCK = 16


def rows(n, raised=()):
    return [(i, f"n{i}", None if i % 7 == 0 else i / 4 + (i in raised)) for i in range(n)]


def load(spark, archive, data, now="2024-01-01 00:00:00", strategy=None):
    result = scd.load_view(archive, spark.createDataFrame(data, "k int, name string, v double"), now, strategy)
    assert result.status == "success", result.error
    return archive


def rewrite(archive, change):
    """Damage the first stored part that holds open rows, behind the archive's back."""
    (part,) = [p.dir for p in archive.manifest().parts if p.state == "open"]
    path = f"{archive.path}/{part}"
    kept = change(archive.spark.read.parquet(path).coalesce(1)).collect()
    schema = archive.spark.read.parquet(path).schema
    archive.spark.createDataFrame(kept, schema).coalesce(1).write.mode("overwrite").parquet(path)


def test_follows_loads_and_clustering(spark, store):
    archive = load(spark, store.archive("s", "v"), rows(100))
    tree = DigestTree(archive, BLOCK)
    assert tree.refresh() == 100
    load(spark, archive, rows(110, raised=(5, 50)), "2024-01-02 00:00:00")
    assert tree.refresh() == archive.manifest().max_id == 112
    assert [f[:2] for f in tree.folders()] == [(0, 100), (100, 112)]
    cluster_archive(archive, "2024-01-03 00:00:00")
    assert tree.verify().collect() == []
    (root,) = tree.root().collect()
    assert (root.node, root.versions, root.mismatches) == (0, 112, 0)
    again = DigestTree(archive, BLOCK)
    again.path += "-anew"
    again.refresh()
    assert differing_blocks(tree, again).collect() == []


@pytest.mark.parametrize("kind", ["altered", "lost", "rehashed"])
def test_names_the_row(spark, store, kind):
    archive = load(spark, store.archive("s", "v"), rows(100))
    tree = DigestTree(archive, BLOCK)
    tree.refresh()
    (bad,) = [r._archive_id for r in archive.read().filter("k = 40").collect()]
    hit = F.col("_archive_id") == bad

    def change(df):
        if kind == "lost":
            return df.filter(~hit)
        if kind == "altered":
            return df.withColumn("v", F.when(hit, 1e9).otherwise(F.col("v")))
        return df.withColumn("_row_hash", F.when(hit, F.lit("0" * 64)).otherwise(F.col("_row_hash")))

    rewrite(archive, change)
    node = (bad - 1) // BLOCK
    (row,) = tree.verify().collect()
    lost, wrong = kind == "lost", kind != "lost"
    assert (row.node, row.versions, row.mismatches) == (node, row.stored_versions - lost, int(wrong))
    assert row.suspect == (None if kind == "rehashed" else bad)
    # a range that does not touch the block is not read and not reported
    assert tree.verify(after=(node + 1) * BLOCK).collect() == []
    assert len(tree.verify(after=bad - 1, upto=bad).collect()) == 1


def test_two_altered_rows_name_the_block_only(spark, store):
    archive = load(spark, store.archive("s", "v"), rows(100))
    tree = DigestTree(archive, BLOCK)
    tree.refresh()
    rewrite(archive, lambda df: df.withColumn("v", F.when(F.col("_archive_id").isin(33, 40), F.lit(-1.0)).otherwise(F.col("v"))))
    (row,) = tree.verify().collect()
    assert (row.node, row.mismatches, row.suspect) == (2, 2, None)


@pytest.mark.parametrize("most", [sidetable.MAX_BLOCKS, 0], ids=["drill down", "all leaves"])
def test_copies_are_compared(spark, store, monkeypatch, most):
    monkeypatch.setattr(sidetable, "MAX_BLOCKS", most)
    n = BLOCK * (FAN + 3)
    trees = []
    for name, data in {"a": rows(n), "b": rows(n, raised=(30,)), "c": rows(n + 20)}.items():
        trees.append(DigestTree(load(spark, store.archive("s", name), data), BLOCK))
        trees[-1].refresh()
    a, b, c = trees
    (row,) = differing_blocks(a, b).collect()
    assert a.archive.read().filter(F.col("_archive_id") == row.suspect).first().k == 30
    if most:
        assert differing_blocks(a, a).collect() == []
        assert sum(r.versions - r.stored_versions for r in differing_blocks(a, c).collect()) == 20


def test_empty_archive(spark, store):
    tree = DigestTree(load(spark, store.archive("s", "v"), []), BLOCK)
    assert tree.refresh() == 0 and tree.read() is None
    with pytest.raises(ValueError, match="refresh"):
        tree.root()
