"""The manifest against a tree built level by level."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from tests.llm.conftest import SCHEMA
from yearring.llm.merkle import backward, folded, forward, h, height, merkle_manifest


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """Root, and for each leaf its siblings level by level with their sides."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 2]) for i in range(0, len(last), 2)])
    proofs = []
    for i in range(len(leaves)):
        proof = []
        for level in levels[:-1]:
            proof.append((level[i ^ 1], bool(i & 1)) if i ^ 1 < len(level) else None)
            i >>= 1
        proofs.append(proof)
    return levels[-1][0], proofs


def brute(rows):
    """``rows``: doc_id, source, lang, n_chars, text."""

    def leaf(doc_id, source, lang, n_chars, text):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row), row))
    built = {}
    for lang, members in trees.items():
        members.sort(key=lambda m: m[:3])
        built[lang] = brute_tree([m[2] for m in members])
    langs = sorted(built, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = brute_tree([built[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        for (_, _, one, row), proof in zip(trees[lang], built[lang][1]):
            seen, path = one, [*proof, *top]
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                seen = leaf(*row[:3], row[3] + 1, row[4])
            for step in path:
                seen = digest(seen) if step is None else digest(step[0], seen) if step[1] else digest(seen, step[0])
            out.append((row[0], one, built[lang][0], root, digest(*[s[0] for s in path if s]), seen, seen == root))
    return Counter(out)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 64, 100, 257])
def test_sweeps(n):
    leaves = [h(str(i).encode()) for i in range(n)]
    root, proofs = brute_tree([x.decode() for x in leaves])
    known, left = forward({(0, i): d for i, d in enumerate(leaves)}, n)
    assert left == [(height(n), 0)] and known[left[0]].decode() == root
    found = dict(backward(known, {left[0]: b""}, {(0, i): d for i, d in enumerate(leaves)}, n))
    for i in range(n):
        assert found[0, i].decode() == "".join(s[0] for s in proofs[i] if s)
        assert folded(leaves[i], found[0, i], (i, n)).decode() == root
    # any run completes all that lies inside it and sends few messages out
    a, b = n // 3, n - n // 4
    known, left = forward({(0, i): leaves[i] for i in range(a, b)}, n)
    assert sorted(k for level, idx in left for k in range(idx << level, min((idx + 1) << level, n))) == list(range(a, b))
    assert len(left) <= 2 * height(n) + 1


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def answers(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("levels", [(16, 10), (2, 1)])
def test_odd_rows(nasty, levels):
    _, df = nasty
    assert answers(merkle_manifest(df, *levels)) == brute(rows_of(df))


def test_hot_and_tiny_trees(spark):
    rng = random.Random(5)
    langs = ["hot"] * 900 + [f"l{i}" for i in range(45)] + [None, "", "é", "=", "one", "one"]
    rows = [(rng.randrange(700), f"t{i}", lang, f"s{i % 7}", rng.choice([None, i])) for i, lang in enumerate(langs)]
    rows += [(None, "n", "hot", None, 3)] * 5
    df = spark.createDataFrame([(*r, None, None, None, None, None, None, None) for r in rows], SCHEMA).repartition(6)
    got = answers(merkle_manifest(df, 3, 2))
    assert got == brute(rows_of(df))
    assert len({r[3] for r in got}) == 1 and not all(r[6] for r in got) and any(r[6] for r in got)


def test_empty(empty):
    assert merkle_manifest(empty).collect() == []
