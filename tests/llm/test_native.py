"""Winnowing and personal data: results against plain Python, and plans without Python."""

from __future__ import annotations

import hashlib
import random
import time
import re
from collections import Counter

import pytest
import xxhash

from tests.llm.conftest import filled, SCHEMA
from yearring.llm import pii, winnowing

PYTHON = ("Python", "Pandas", "Arrow")


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [name for name in PYTHON if name in plan]


def rows_in_order(rows):
    """Ids descending, then texts descending; rows with null ids apart."""
    return sorted(((i, t or "") for i, t in rows if i is not None), reverse=True)


def units_of(text):
    """Words, and the overlapping pieces of long ones."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    piece = winnowing.PIECE
    return [u for w in words for u in ([w] if len(w) <= winnowing.LONG else [w[i : i + piece] for i in range(len(w) - piece + 1)])]


def brute_prints(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    """Chosen (position, hash) of a text, window by window."""
    units = units_of(text)

    def top(*parts):
        seed = 42  # of Spark's xxhash64, which hashes on from one column to the next
        for part in parts:
            seed = xxhash.xxh64_intdigest(part.encode(), seed)
        return seed >> 32

    if not units:
        return []
    if len(units) < gram:
        return [(0, top(" ".join(units)))]
    hashes = [top(*units[i : i + gram]) for i in range(len(units) - gram + 1)]
    if len(hashes) < window:
        return list(enumerate(hashes))
    chosen = {max(range(s, s + window), key=lambda k: (-hashes[k], k)) for s in range(len(hashes) - window + 1)}
    return [(k, hashes[k]) for k in sorted(chosen)]


def brute_likeness(a, b):
    x, y = {h for _, h in a}, {h for _, h in b}
    return len(x & y) / len(x | y) if x | y else 1.0


def test_all_columns_against_brute_force(spark, nasty):
    rng = random.Random(3)
    kana = "".join(chr(0x3042 + rng.randrange(80)) for _ in range(2700))
    texts = [(900 + i, t) for i, t in enumerate([kana, kana[300:2300] + kana[:200], "a " + "b" * 41, "🙂" * 60 + " x y z", "b" * 40, "one two three one two three"])]
    rows = [(i, t) for i, t in nasty[0] if i is not None and i < 900 or i is None] + texts
    rows = list({i: (i, t) for i, t in rows if i is not None}.values())  # one row of an id, so that rows can be told apart
    order = rows_in_order(rows)
    prints = {t: brute_prints(t) for _, t in order}
    show = lambda entries: " ".join(f"{h:X}@{k:X}" for k, h in entries)
    want = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = brute_prints(t[: len(t) - half] + after[:half])
        want[i] = (show(prints[t]), show(edited), brute_likeness(prints[t], edited), brute_likeness(prints[t], prints[after]))
    got = winnowing.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got} == want
    near = {r.doc_id: r for r in got}
    assert near[901].near_next > 0.5 and near[901].near_edited > 0.2  # texts without spaces


def test_edited_texts(nasty):
    rows, df = nasty
    out = winnowing.compared(df)
    no_python(out)
    got = out.collect()
    order = rows_in_order(rows)
    want = Counter()
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        want[i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    for i, t in rows:
        if i is None:
            t = t or ""
            want[i, len(t), hashlib.sha256(t[: len(t) - len(t) // 2].encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = {}
    texts = {i: t or "" for i, t in rows if i is not None}
    for r in got:
        if r.doc_id is not None:
            assert same.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_window_minima(spark, nasty):
    """Every window of hashes has a chosen entry at its smallest hash, the rightmost of ties; and nothing else is chosen."""
    rows, df = nasty
    gram, window = 2, 5
    prints = {r.doc_id: [(e.hash, e.position) for e in r.entries] for r in winnowing.fingerprints(df, gram=gram, window=window).collect() if r.doc_id is not None}
    grams = {" ".join(w[i : i + gram]) for _, t in rows for w in [units_of(t)] for i in range(len(w) - gram + 1)}
    pairs = spark.createDataFrame([tuple(g.split(" ")) for g in grams if g.count(" ") == 1], "a string, b string").selectExpr("a", "b", "shiftrightunsigned(xxhash64(a, b), 32) h")
    hash_of = {(r.a, r.b): r.h for r in pairs.collect()}
    for i, t in rows:
        words = units_of(t)
        if i is None or len(words) < gram:
            continue
        hashes = [hash_of[a, b] for a, b in zip(words, words[1:])]
        if len(hashes) < window:
            want = set(enumerate(hashes))
        else:
            want = set()
            for s in range(len(hashes) - window + 1):
                least = min(hashes[s : s + window])
                want.add((max(k for k in range(s, s + window) if hashes[k] == least), least))
        assert sorted(prints[i], key=lambda e: e[1]) == [(h, k) for k, h in sorted(want)]


def test_match_guarantee(spark):
    """Texts that share GRAM + WINDOW - 1 words in a row share a hash."""
    rng = random.Random(1)
    length = winnowing.GRAM + winnowing.WINDOW - 1
    rows = []
    for i in range(0, 200, 2):
        shared = [f"s{rng.random()}" for _ in range(length)]
        for k in range(2):
            around = [[f"w{rng.random()}" for _ in range(rng.randrange(0, 30))] for _ in range(2)]
            rows.append((i + k, " ".join(around[0] + shared + around[1])))
    prints = {r.doc_id: {e.hash for e in r.entries} for r in winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(prints[i] & prints[i + 1] for i in range(0, 200, 2))


def test_neighbours_over_wide_ranges(spark):
    ids = sorted({-(2**63), -5, -1, 0, 1, 2, 2**16, 2**16 + 1, 2**32, 2**48 + 7, 2**63 - 1, 12345678901234})
    got = {r.id: r.next_id for r in winnowing.neighbours(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    assert got == {i: ids[k - 1] for k, i in enumerate(ids)}


# The plain forms of the base patterns.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            valid = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in match.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if valid:
                found.append((match.start(), number, f"{kind}:{match.start()}:{match.end()}"))
    return [name for _, _, name in sorted(found)]


BITS = ["a", "b1", "@", "ex.com", ".", "-", "_", "%", " ", "1", "22", "255", "256", "300", "+1", "(", "555", ")", "-1234", "4111 1111 1111 1111", "378282246310005", "é", "\n"]
BITS += ["(at)", "[at]", "[dot]", "123-45-6789", "call 555-123-4567", "10.0.0.1", "01.002.3.4", "+1 (555) 555-0100", "😀"]


@pytest.fixture(scope="module")
def fuzzed():
    rng = random.Random(5)
    return [(10_000 + i, "".join(rng.choice(BITS) for _ in range(rng.randrange(0, 14)))) for i in range(1500)]


def test_personal_data(spark, nasty, fuzzed):
    small = [(i, t) for i, t in nasty[0] if i not in (503, 504)]
    rows = small + fuzzed
    df = spark.createDataFrame(filled(rows), SCHEMA)
    out = pii.pii_spans(df)
    no_python(out)
    want, added = Counter(), 0
    for i, t in rows:
        spans = base_spans(t or "")
        want[i, *[sum(s.startswith(k + ":") for s in spans) for k in PLAIN], hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    got = out.collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    texts = dict(rows)
    for r in got:
        names = [s for s in r.spans.split(",") if s]
        base = set(base_spans(texts[r.doc_id] or "")) if r.doc_id is not None else set()
        assert base <= set(names)
        places = [tuple(map(int, s.split(":")[1:])) for s in names]
        assert places == sorted(places, key=lambda p: p[0]) and all(0 <= a < b <= len(texts[r.doc_id] or "") for a, b in places)
        for a, b in [tuple(map(int, s.split(":")[1:])) for s in names if s not in base]:
            added += 1
            assert not [1 for s in base for x, y in [tuple(map(int, s.split(":")[1:]))] if a < y and x < b]
    assert added


def test_long_runs_take_linear_work(spark, nasty):
    """Texts of one run of letters or digits: no overflow, no hang."""
    rows = [(i, t) for i, t in nasty[0] if i in (500, 503, 504)]
    got = {r.doc_id: r for r in pii.pii_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[500].spans == "" and got[503].n_card == 0
    assert got[504].n_email == 1


def test_redaction(spark):
    rows = [(1, "mail me: joe@example.com or +1 (555) 555-0100!", "x"), (2, None, None), (3, "no data", "y"), (4, "é😀 10.1.2.3", None)]
    out = pii.redact(spark.createDataFrame(rows, "doc_id long, text string, start string"))
    no_python(out)
    assert out.columns == ["doc_id", "text", "start"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "mail me: <EMAIL> or <PHONE>!", 2: None, 3: "no data", 4: "é😀 <IP>"}


def test_many_spans_take_linear_work(spark):
    """One text of twice the spans takes about the time of two texts; quadratic work would take twice that."""
    def seconds(n, texts):
        text = " ".join(f"user{i}@example.com" for i in range(n))
        df = spark.createDataFrame([(k, text) for k in range(texts)], "doc_id long, text string").repartition(1)
        start = time.perf_counter()
        got = pii.pii_spans(df).collect()
        assert [r.n_email for r in got] == [n] * texts
        return time.perf_counter() - start

    seconds(2000, 1)
    two, one = seconds(20_000, 2), seconds(40_000, 1)
    assert one <= 1.5 * two + 2, (one, two)


def test_redaction_of_a_long_text(spark):
    rng = random.Random(5)
    words = [rng.choice(["é😀", "plain", "\n", f"user{i}@example.com", "x" * 90]) for i in range(30_000)]
    text = " ".join(words)
    df = spark.createDataFrame([(1, text), (2, text[:4096]), (3, "a@b.com")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got[1] == " ".join("<EMAIL>" if "@" in w else w for w in words)
    assert got[3] == "<EMAIL>" and "<EMAIL>" in got[2]


def test_reliabilities_favour_agreeing_labelers(spark):
    """Three labelers that agree outweigh one that votes at random."""
    rng, votes = random.Random(3), []
    for _ in range(400):
        truth = rng.random() < 0.5
        votes.append(("card", [int(truth), int(truth) if rng.random() < 0.9 else None, int(truth ^ (rng.random() < 0.1)), rng.randrange(2)]))
    patterns = spark.createDataFrame(votes, "kind string, votes array<int>").groupBy("kind", "votes").count()
    for r in pii._reliabilities(patterns).collect():
        if r.votes[1] is not None and len(set(r.votes[:3])) == 1:
            assert (r.truth > 0.9) == (r.votes[0] == 1)


def test_empty_tables(empty):
    assert winnowing.compared(empty).collect() == []
    assert winnowing.fingerprints(empty).collect() == []
    assert pii.pii_spans(empty).collect() == []
    assert pii.redact(empty).collect() == []
