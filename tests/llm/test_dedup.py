"""Exact, substring and near dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from yearring.llm import exact_dedup, golomb, simhash, substring_dedup

LAST = float("inf")


def lowered(text):
    return (text or "").encode().lower()


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 100, 5000):
        for top in (1 << 20, (1 << 64) - 1):
            values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
            assert (golomb.decode(golomb.encode(values)) == values).all()
    dense = np.arange(1000, dtype=np.uint64)
    assert len(golomb.encode(dense)) < 300
    assert (golomb.decode(golomb.encode(dense)) == dense).all()


def test_exact(nasty):
    rows, df = nasty
    got = exact_dedup.exact_dedup(df).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((i, best[lowered(t)], len(groups[lowered(t)]), hashlib.sha256(lowered(t)).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == Counter({hashlib.sha256(t).hexdigest(): 1 for t in groups})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_keeps_columns(nasty):
    rows, df = nasty
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert Counter(lowered(r.text) for r in out.collect()) == Counter({lowered(t): 1 for _, t in rows})


def test_exact_tells_colliding_fingerprints_apart(nasty, monkeypatch):
    """Only the bytes decide: with a fingerprint of one value the result is the same."""
    rows, df = nasty
    import pyarrow as pa

    full = exact_dedup._digests

    def same(texts):
        return full(texts) | {"fp": pa.array([7] * len(texts), pa.int64())}

    monkeypatch.setattr(exact_dedup, "_digests", same)
    got = exact_dedup.exact_dedup(df).collect()
    sizes = Counter(lowered(t) for _, t in rows)
    assert Counter(r.group_size for r in got) == Counter(sizes[lowered(t)] for _, t in rows)


def windows(rows, length):
    first = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for s in range(len(words) - length + 1):
            key, place = tuple(words[s : s + length]), (LAST if i is None else i, s)
            first[key] = min(first.get(key, place), place)
    return first


@pytest.mark.parametrize("length,seed", [(20, 8), (6, 3)])
def test_substring(nasty, length, seed):
    rows, df = nasty
    first = windows(rows, length)
    want = Counter()
    for i, t in rows:
        words = (t or "").encode().split()
        gone = np.zeros(len(words), bool)
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < (LAST if i is None else i, s):
                gone[s : s + length] = True
        want[i, len(words), int(gone.sum()), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest()] += 1
    got = substring_dedup.substring_dedup(df, length=length, seed=seed).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert all(sum(x.end - x.start for x in r.repeats) == r.n_removed for r in got)


def print_of(text):
    words = lowered(text).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    votes = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=int)
    return int("".join("1" if 2 * v > len(hashes) else "0" for v in votes), 2)


def components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_index_finds_all_links():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**64, 30, dtype=np.uint64)
    flip = lambda v: v ^ (np.uint64(1) << rng.integers(0, 64, len(v)).astype(np.uint64))
    values = np.unique(np.concatenate([centre, flip(np.repeat(centre, 8)), flip(flip(np.repeat(centre, 8))), np.array([0, 2**64 - 1], np.uint64)]))
    for radius in (0, 1, 2, 5):
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
        want = {(int(values[a]), int(values[b])) for a, b in zip(*np.nonzero(np.triu(near, 1)))}
        index = simhash.GrayIndex(values)
        got = {tuple(sorted((int(index.values[x]), int(index.values[y])))) for a, b, _ in index.links(radius) for x, y in zip(a, b)}
        assert got == want
        place = {int(v): i for i, v in enumerate(values)}
        a, b = simhash.spanning_links(values, radius)
        tree = [(place[int(x)], place[int(y)]) for x, y in zip(a, b)]
        assert len(tree) < len(values)
        assert components(len(values), tree) == components(len(values), [(place[x], place[y]) for x, y in want])


@pytest.mark.parametrize("group", [simhash.GROUP, 3])
def test_near_dedup(nasty, monkeypatch, group):
    """Also with groups so small that they are cut again."""
    rows, df = nasty
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.RADIUS, group))
    got = simhash.near_dedup(df).collect()
    prints = [print_of(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = components(len(rows), linked)
    names = defaultdict(list)
    for root, (i, _) in zip(roots, rows):
        names[root].append(i)
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in names.items()}
    want = Counter((i, f"{p:016x}", least[root]) for (i, _), p, root in zip(rows, prints, roots))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("group", [simhash.GROUP, 40])
def test_ranges_lose_no_link(spark, monkeypatch, group):
    """Dense and sparse fingerprints with differences in leading and trailing bits, in many ranges and in cut ones."""
    monkeypatch.setattr(simhash, "RANGE", 20)
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    prints = {rng.getrandbits(64) for _ in range(300)} | set(centres)
    for centre in centres:
        for _ in range(8):
            prints.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.choice([63, 62, 61, 60, 0, 1, rng.randrange(64)])))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), simhash.RADIUS, group).collect()
    place = {p: i for i, p in enumerate(signed)}
    got = [(place[r.a], place[r.b]) for r in rows]
    want = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS]
    assert {(max(p), min(p)) for p in got} <= set(want)
    assert components(len(prints), got) == components(len(prints), want)


def test_connected_chains_and_hubs(spark):
    """A long path, a star and a ring each become one component."""
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)] + [(7, 7)]
    got = {r.node: r.root for r in simhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 0 for i in range(1, 40)} | {i: 200 for i in range(201, 230)}


def test_near_copies(nasty):
    rows, df = nasty

    def shingles(t):
        words = lowered(t).split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    order = sorted(range(len(rows)), key=lambda n: LAST if rows[n][0] is None else rows[n][0])
    sets = [shingles(rows[n][1]) for n in order]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots = components(len(rows), linked)
    want = Counter(rows[n][0] for k, n in enumerate(order) if roots[k] == k)
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == want


def kept_by_brute_force(rows):
    """Ids that stay when all pairs are compared; and the similarity of each pair that is alike."""

    def shingles(t):
        words = lowered(t).split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    order = sorted(range(len(rows)), key=lambda n: LAST if rows[n][0] is None else rows[n][0])
    sets = [shingles(rows[n][1]) for n in order]
    near = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(len(rows)) for b in range(a)}
    linked = [pair for pair, share in near.items() if share >= 0.8]
    roots = components(len(rows), linked)
    return Counter(rows[n][0] for k, n in enumerate(order) if roots[k] == k), [near[pair] for pair in linked]


def stay(spark, rows):
    return Counter(r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect())


def test_near_copies_at_the_threshold(spark):
    """Copies with text appended, cut off or edited, at a similarity of 0.80 to 0.85, are all found."""
    rng, rows = random.Random(5), []
    word = lambda: f"word{rng.randrange(10**9)}"
    for i in range(60):
        words = [word() for _ in range(200)]
        if i % 3 == 0:
            copy = words + [word() for _ in range(rng.randrange(36, 49))]
        elif i % 3 == 1:
            copy = words[: rng.randrange(161, 170)]
        else:
            copy = [word() if k in (30, 75, 120, 165) else w for k, w in enumerate(words)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    want, shares = kept_by_brute_force(rows)
    assert len(shares) == 60 and all(0.8 <= s <= 0.85 for s in shares)
    assert stay(spark, rows) == want


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_near_copies_with_shared_passages(spark, monkeypatch, block):
    """Texts of one template, alike and not, and chains of copies; also with blocks so small that there are many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng, rows = random.Random(6), []
    word = lambda: f"w{rng.randrange(10**6)}"
    template = [word() for _ in range(100)]
    for i in range(60):
        rows.append((i, " ".join(template + [word() for _ in range(rng.randrange(0, 30))])))
        if i % 4 == 0:
            rows.append((1000 + i, rows[-1][1] + " " + word()))
    chain = [word() for _ in range(120)]
    for i in range(20):
        rows.append((100 + i, " ".join(chain[2 * i : 2 * i + 60])))
    rng.shuffle(rows)
    assert stay(spark, rows) == kept_by_brute_force(rows)[0]


def test_near_copies_among_equal_words(spark):
    """Rows of the same long words: copies in the middle are found though the first and the last row are unlike them."""
    rng, rows = random.Random(8), []
    words = [f"word{rng.randrange(10**9)}" for _ in range(60)]
    for i in range(30):
        rng.shuffle(words)
        rows.append((2 * i, " ".join(words) + f" n{i}"))
        if 0 < i < 29:
            rows.append((2 * i + 1, " ".join(words) + f" m{i}"))
    want, shares = kept_by_brute_force(rows)
    assert len(shares) == 28
    assert stay(spark, rows) == want


def test_near_copies_of_seven_and_eight_long_words(spark):
    """One long word more does not hide a copy, however few long words there are."""
    rng, rows = random.Random(9), []
    for i in range(30):
        words = [f"word{rng.randrange(10**9)}" for _ in range(7)] + [f"{rng.randrange(10**4)}" for _ in range(21)]
        rng.shuffle(words)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words) + f" word{rng.randrange(10**9)}")]
    want, shares = kept_by_brute_force(rows)
    assert len(shares) == 30 and min(shares) == 0.96
    assert stay(spark, rows) == want


def test_near_copies_with_unlike_fingerprints_between(spark):
    """Pairs of copies among 40 texts of nearly the same words in another order, whose fingerprints lie between theirs."""
    rng, rows = random.Random(7), []
    word = lambda: f"word{rng.randrange(10**9)}"
    for family in range(12):
        words = [word() for _ in range(200)]
        extra = [word() for _ in range(40)]
        rows += [(1000 * family, " ".join(words)), (1000 * family + 1, " ".join(words + extra))]
        for i in range(40):
            mixed = words + extra[: i + 1]
            rng.shuffle(mixed)
            rows.append((1000 * family + 2 + i, " ".join(mixed)))
    want, shares = kept_by_brute_force(rows)
    assert len(shares) == 12
    assert stay(spark, rows) == want


def test_empty_tables(empty):
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert exact_dedup.drop_copies(empty).collect() == []
    assert substring_dedup.substring_dedup(empty).collect() == []
    assert simhash.near_dedup(empty).collect() == []
    assert simhash.drop_near_copies(empty).collect() == []
