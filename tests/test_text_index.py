"""Searches through the trigram index, against a plain ``ilike``."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from yearring.operators import scd, sidetable
from yearring.operators.compaction import cluster_archive
from yearring.operators.text_index import TextIndex, literal_runs, wanted_grams

PATTERNS = ["%NEEDLE 17%", "%needle%", "a_c", "%100\\% sure%", "%naïve wörd%", "%k%elvin%", "%line\nbreak%", "%no such text%"]


def texts(n, seed):
    rng = random.Random(seed)
    odd = [None, "", "ab", "a c", "100% sure", "100x sure", "x_y", "xzy", "a naïve WÖRD", "Kelvin", "line\nbreak", "🙂🙂needle🙂", "ABC" * 500]
    return [(i, odd[i % 97] if i % 97 < len(odd) else f"SELECT {rng.choice(['a', 'b'])} from t{rng.randrange(40)}") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, note string")


@pytest.fixture
def archive(spark, store):
    archive = store.archive("s", "v")
    rows = texts(1500, 1)
    rows[17] = (17, "select Needle 17 from t")
    scd.load_view(archive, frame(spark, rows), "2024-01-01 00:00:00")
    return archive


def keys(df):
    return sorted(df.select("_archive_id", "k", "_is_current").collect())


def same(archive, index, patterns, state=None):
    rows = archive.read(state)
    expected = [r for p in patterns for r in rows.filter(F.col("note").ilike(p)).select(F.lit(p), "_archive_id", "_is_current").collect()]
    found = [r for p in patterns for r in index.search(p, state).select(F.lit(p), "_archive_id", "_is_current").collect()]
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def test_pieces_of_a_pattern():
    assert literal_runs("%Abc_de\\%f%é\\\\x") == ["abc", "de%f", "\\x"]
    assert wanted_grams("%abcab%") == ["abc", "bca", "cab"]
    assert wanted_grams("%ab%cd_%") == []
    assert len(wanted_grams("%the quick brown fox%", 5)) == 5


def test_ranges():
    assert sidetable.spans([]) == [] and sidetable.spans([4]) == [(4, 4)]
    assert sidetable.spans([1, 2, 3, 7, 8, 20]) == [(1, 3), (7, 8), (20, 20)]
    assert sidetable.spans([1, 2, 3, 7, 8, 20], 2) == [(1, 8), (20, 20)]
    assert sidetable.spans([0, 2, 4, 6], 2) == [(0, 0), (2, 6)]
    assert sidetable.spans([0, 5, 9], 1) == [(0, 9)]


@pytest.mark.parametrize("most", [sidetable.MAX_BLOCKS, 1], ids=["ranges", "join"])
def test_same_rows_as_a_plain_search(spark, archive, monkeypatch, most):
    monkeypatch.setattr(sidetable, "MAX_BLOCKS", most)
    index = TextIndex(archive, "note", 64)
    assert index.refresh() == archive.manifest().max_id == index.refresh()
    changed = [(k, "now a needle" if k % 500 == 3 else note) for k, note in texts(1200, 1)]
    scd.load_view(archive, frame(spark, changed), "2024-01-02 00:00:00")
    for pattern in PATTERNS[:2]:  # the second load is not indexed yet
        same(archive, index, [pattern], "open")
    index.refresh()
    cluster_archive(archive, "2024-01-03 00:00:00")
    same(archive, index, PATTERNS if most > 1 else PATTERNS[:2])


def test_before_the_first_refresh(archive):
    assert len(keys(TextIndex(archive, "note").search("%needle 17%"))) == 1


def test_only_matching_blocks_are_read(archive):
    index = TextIndex(archive, "note", 64)
    index.refresh()
    (block,) = [r.block for r in index.blocks("%needle 17%").collect()]
    found = index.search("%needle 17%")
    assert len(found.collect()) == 1
    text = found._jdf.queryExecution().toString()
    assert re.search(rf">= {block * 64 + 1}\).*<= {block * 64 + 64}\)", text)
    # one file of several is read, as ids of a file are consecutive
    plan = found._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    assert plan.metrics().get("numOutputRows").get().value() < 1500 / 2
