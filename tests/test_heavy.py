"""Top values from daily summaries, against plain counts."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from yearring.operators import scd
from yearring.operators.heavy import HeavyHitters, bound

SCHEMA = "k long, who string, at timestamp_ntz"


def rows(n, seed, flat=False):
    rng, start = random.Random(seed), datetime(2024, 1, 1)
    for k in range(n):
        who = f"v{rng.randrange(900)}" if flat else rng.choice([None, "hot", "hot", "warm", f"w{rng.randrange(5)}", f"tail{rng.randrange(3000)}"])
        yield (seed * 10**6 + k, who, start + timedelta(hours=rng.randrange(24 * 10), minutes=seed))


def top(data, limit, start, end):
    days = [r for r in data if date.fromisoformat(start) <= r[2].date() < date.fromisoformat(end)]
    counts = Counter(r[1] for r in days if r[1] is not None)
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:limit]


@pytest.mark.parametrize("flat", [False, True], ids=["skewed", "flat"])
def test_equals_plain_counts(spark, store, flat):
    archive, data = store.archive("s", "v"), []
    heavy = HeavyHitters(archive, "who", "at", 200)
    for seed in (1, 2):
        data += rows(3000, seed, flat)
        result = scd.load_view(archive, spark.createDataFrame(data, SCHEMA), f"2024-02-0{seed} 00:00:00", "APPEND_ONLY")
        assert result.status == "success", result.error
        heavy.refresh()
    for limit, start, end in [(5, "2024-01-01", "2024-01-11"), (5, "2024-01-03", "2024-01-06"), (5, "2030-01-01", "2030-01-02")]:
        assert [tuple(r) for r in heavy.top(limit, start, end).collect()] == top(data, limit, start, end)
    assert heavy.candidates("2024-01-01", "2024-01-11").count() <= 200


def test_bound():
    assert bound(1000, 1000) == 0 and bound(10**9, 0) == int(7 / 16384 * 10**9) and bound(100, 99, 1) == 1


def test_ended_versions_are_refused(spark, store):
    archive = store.archive("s", "v")
    data = list(rows(20, 1))
    scd.load_view(archive, spark.createDataFrame(data, SCHEMA), "2024-02-01 00:00:00")
    scd.load_view(archive, spark.createDataFrame(data[5:], SCHEMA), "2024-02-02 00:00:00")
    with pytest.raises(ValueError, match="don't end"):
        HeavyHitters(archive, "who", "at").refresh()
