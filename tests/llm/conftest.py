from __future__ import annotations

import random

import pytest

from yearring.llm.queries import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part long, row int, data string, fp long, score double, start long, node long"


def filled(rows):
    """Rows of (id, text) with other columns, some null, whose names the operators use themselves."""
    return [(i, t, None if n % 3 else "en", "src0", None if t is None else len(t), n, None, "x", 0, 0.1, 5, n) for n, (i, t) in enumerate(rows)]


def prose(rng: random.Random, n: int) -> str:
    stems = [a + b + c for a in ("th", "on", "re", "st", "ou", "bl") for b in ("an", "er", "is", "at", "or") for c in ("ed", "ing", "ly", "es", "")]
    return " ".join(rng.choice(stems) for _ in range(n))


def nasty_rows():
    rng = random.Random(11)
    passage = prose(rng, 60)
    rows = [(None, None), (None, "null id"), (None, "null id"), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "One"), (6, "a b"), (7, "Ärger ÄRGER straße 日本語 😀")]
    rows += [(100, prose(rng, 40))] * 3  # the same row again
    rows += [(200 + i, "The same text in many rows. " * 5) for i in range(40)]
    rows += [(300 + i, prose(rng, rng.randrange(5, 120))) for i in range(40)]
    rows += [(400 + i, prose(rng, 30) + " " + passage + " " + prose(rng, 30)) for i in range(12)]
    rows += [(500, "x" * 200_000), (501, prose(rng, 60_000)), (502, "a " * 40_000), (503, "1" * 30_000), (504, "a.b" * 10_000 + "@" + "c.d" * 10_000)]
    near = prose(rng, 120).split()
    for i in range(6):
        changed = list(near)
        changed[10 + 17 * i] = "changed"
        rows.append((600 + i, " ".join(changed if i else near)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def nasty(spark):
    rows = nasty_rows()
    return rows, spark.createDataFrame(filled(rows), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
