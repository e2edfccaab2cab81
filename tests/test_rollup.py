"""Rollups that follow loads with changes and deletions, against a recompute."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from yearring.operators import scd
from yearring.operators.compaction import cluster_archive, vacuum
from yearring.operators.rollup import RANK_ERROR, Rollup, RollupStore

ROLLUP = Rollup("r", ("day", "who", "kind", "v"), "day", {"kind": "kind"}, {"total": "v"}, {"people": "who"}, {"spread": "v"})
TIMES = [f"2024-01-{d:02d} 00:00:00" for d in range(1, 20)]


def states(n, seed):
    rng, rows = random.Random(seed), {}
    for _ in range(n):
        for k in rng.sample(range(60), 25):
            rows[k] = (rng.randrange(6), rng.choice(["a", "b", "c", None]), rng.choice(["x", "y"]), rng.choice([None, 1.25, 2.5, 7.0]))
        for k in rng.sample(sorted(rows), 8):
            del rows[k]
        yield [*rows.values(), *list(rows.values())[:3]]


def frame(spark, rows):
    return spark.createDataFrame(rows, "day int, who string, kind string, v double")


def open_rows(archive):
    """Copies of a current row may differ in number from the source's; rollups follow the archive."""
    return [(r.day, r.who, r.kind, r.v) for r in archive.read("open").collect()]


def check(store, rows):
    sums, people = defaultdict(lambda: [0, None]), defaultdict(set)
    for day, who, kind, v in rows:
        entry = sums[day, kind]
        entry[0] += 1
        entry[1] = entry[1] if v is None else (entry[1] or 0) + v
        people[kind] |= {who} - {None} if 1 <= day < 5 else set()
    got = {(r.period, r.kind): [r.row_count, None if r.total is None else float(r.total)] for r in store.sums().collect()}
    assert got == {k: v for k, v in sums.items()}
    assert {r.kind: r.people for r in store.distinct("people", 1, 5, ["kind"]).collect()} == {k: len(v) for k, v in people.items() if v}
    assert store.distinct("people").first().people == len({r[1] for r in rows} - {None})
    (row,) = store.quantile("spread", 0.5).collect() or [None]
    values = sorted(r[3] for r in rows if r[3] is not None)
    assert row.row_count == len(values) and row.spread in values
    low, high = (sum(v < row.spread for v in values), sum(v <= row.spread for v in values))
    assert low <= (0.5 + RANK_ERROR) * len(values) + 1 and high >= (0.5 - RANK_ERROR) * len(values) - 1


@pytest.mark.parametrize("carry", [ROLLUP.reads, ()], ids=["carried", "looked up"])
def test_follows_changes_and_deletions(spark, store, carry):
    archive = store.archive("s", "v")
    rollup = RollupStore(archive, ROLLUP)
    for i, rows in enumerate(states(3, 4)):
        result = scd.load_view(archive, frame(spark, rows), TIMES[i], carry=carry)
        assert result.status == "success", result.error
        assert rollup.refresh() == archive.manifest().version == rollup.refresh()
        check(rollup, open_rows(archive))


def test_several_loads_and_a_clustering_at_once(spark, store):
    archive = store.archive("s", "v")
    rollup = RollupStore(archive, ROLLUP)
    for i, rows in enumerate(states(3, 5)):
        scd.load_view(archive, frame(spark, rows), TIMES[i], carry=ROLLUP.reads)
        if i == 0:
            rollup.refresh()
    cluster_archive(archive, TIMES[5])
    rollup.refresh()
    check(rollup, open_rows(archive))
    assert rollup.generation() == 1
    scd.load_view(archive, frame(spark, rows[4:]), TIMES[6], carry=ROLLUP.reads)
    cluster_archive(archive, TIMES[7])
    vacuum(archive)  # the manifests between are gone, so it is built anew
    rollup.refresh()
    check(rollup, open_rows(archive))
    assert rollup.generation() == archive.manifest().version


def test_a_crash_in_a_refresh_is_not_seen(spark, store, monkeypatch):
    archive = store.archive("s", "v")
    rollup = RollupStore(archive, ROLLUP)
    one, two = states(2, 6)
    scd.load_view(archive, frame(spark, one), TIMES[0], carry=ROLLUP.reads)
    rollup.refresh()
    before = open_rows(archive)
    scd.load_view(archive, frame(spark, two), TIMES[1], carry=ROLLUP.reads)

    def crash(*args):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(RollupStore, "_deltas", crash)
        with pytest.raises(RuntimeError):
            rollup.refresh()
    check(rollup, before)
    rollup.refresh()
    check(rollup, open_rows(archive))


def test_a_refresh_reads_new_parts_only(spark, store):
    archive = store.archive("s", "v")
    rollup = RollupStore(archive, ROLLUP)
    one, two = states(2, 7)
    scd.load_view(archive, frame(spark, one), TIMES[0], carry=ROLLUP.reads)
    rollup.refresh()
    scd.load_view(archive, frame(spark, two), TIMES[1], carry=ROLLUP.reads)
    newest = archive.manifest()
    parts = rollup._added(1, newest)
    opened = rollup._stored(newest, [p for p in parts if p.state == "open"])
    ended = rollup._ended(newest, [p for p in parts if p.state == "ends"])
    files = rollup._deltas(opened, ended).inputFiles()
    assert files and all("run=2-" in f for f in files)


def test_empty_archives(spark, store):
    archive = store.archive("s", "v")
    rollup = RollupStore(archive, ROLLUP)
    scd.load_view(archive, frame(spark, []), TIMES[0], carry=ROLLUP.reads)
    rollup.refresh()
    assert rollup.sums().count() == 0 and rollup.distinct("people").collect()[0].people == 0 and rollup.distinct("people", by=["kind"]).count() == 0
    scd.load_view(archive, frame(spark, [(1, "a", "x", 2.0)]), TIMES[1], carry=ROLLUP.reads)
    rollup.refresh()
    assert rollup.sums().filter(F.col("total") == 2).count() == 1 and rollup.distinct("people").first().people == 1
