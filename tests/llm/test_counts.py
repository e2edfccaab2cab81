"""Token counts by section against the library's own offsets."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_tokens import BYTES, library
from yearring.llm import token_counts


def brute(theirs, text, sections):
    """Allot every token by comparing it with every section."""
    counts, crossing = Counter(), Counter()
    for a, b in theirs.encode(text, add_special_tokens=False).offsets:
        shares = [(min(b, e) - max(a, s), -n) for n, (s, e) in enumerate(sections) if min(b, e) > max(a, s)]
        inside = sum(x for x, _ in shares)
        # What lies in no section competes as well; of equal shares the first in the text wins.
        pieces, at = [], a
        for s, e, n in sorted((s, e, n) for n, (s, e) in enumerate(sections) if min(b, e) > max(a, s)):
            if s > at:
                pieces.append((s - at, None))
            pieces.append((min(b, e) - max(a, s), n))
            at = min(b, e)
        if b > at:
            pieces.append((b - at, None))
        best = max(range(len(pieces)), key=lambda k: (pieces[k][0], -k))
        counts[pieces[best][1]] += 1
        crossing[pieces[best][1]] += len(pieces) > 1
        assert inside <= b - a
    return counts, crossing


@pytest.fixture(scope="module")
def theirs():
    return library(BYTES)


def lines_of(text):
    out, at = [], 0
    for line in text.split("\n"):
        out.append((at, at + len(line) + 1))
        at += len(line) + 1
    out[-1] = (out[-1][0], len(text))
    return out[:-1] if len(out) > 1 and out[-1][0] == out[-1][1] else out


def test_lines(spark, nasty, theirs):
    rows, df = nasty
    extra = [(800, "a\n\n\nb \n  c\n"), (801, "日本\n語😀\n\n😀"), (802, "\n"), (803, "é\u0301\n\n\n\n  x<|endoftext|>\ny")]
    rows = rows + extra
    df = df.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = Counter()
    for i, t in rows:
        t = t or ""
        counts, crossing = brute(theirs, t, lines_of(t)) if len(lines_of(t)) < 200 else (None, None)
        for n, (a, b) in enumerate(lines_of(t)):
            want[i, n, a, b, counts[n], crossing[n]] += 1
    got = token_counts.token_counts(df, BYTES).collect()
    assert Counter((r.doc_id, r.section, r.start, r.end, r.n_tokens, r.n_crossing) for r in got) == want


def test_counts_add_up(spark, sf, theirs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n, r.s) for r in token_counts.token_counts(docs, BYTES).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.min("start").alias("s")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {i: (len(theirs.encode(t, add_special_tokens=False).ids), 0) for i, t in texts.items()}


def test_given_sections(spark, theirs):
    """Gaps, empty and unordered sections, sections beyond the text, and none at all."""
    text = "The first thoroughly measured section, and another one 日本語 😀 here."
    cases = [[(0, 9), (9, 30), (40, 60)], [(50, 64), (3, 5), (7, 7)], [(0, 10_000)], [], [(5, 6), (6, 7), (7, 8)], [(58, 59), (62, 63)]]
    rows = [(n, text, [{"start": a, "end": b} for a, b in case]) for n, case in enumerate(cases)] + [(90, text, None), (91, None, [{"start": 0, "end": 3}])]
    out = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string, fields array<struct<start: long, end: long>>"), BYTES, sections_col="fields")
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.n_tokens, r.n_crossing)
    for n, case in enumerate(cases):
        counts, crossing = brute(theirs, text, [(a, min(b, len(text))) for a, b in case])
        assert got[n] == {k: (counts[k], crossing[k]) for k in [*range(len(case)), None]}
    assert set(got[90]) == {None} and got[91] == {0: (0, 0), None: (0, 0)}


def test_overlapping_and_null_sections(spark, theirs):
    """Characters of several sections belong to the first; null sections and borders hold none."""
    text = "The first thoroughly measured section, and another one here."
    sections = [(20, 40), None, (0, 25), (None, 9), (5, 10), (3, None), (0, 25), (30, 60)]
    rows = [(1, text, [s and {"start": s[0], "end": s[1]} for s in sections])]
    out = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string, fields array<struct<start: long, end: long>>"), BYTES, sections_col="fields")
    got = {r.section: tuple(r)[2:] for r in out.collect()}
    counts, crossing = brute(theirs, text, [(25, 40), (0, 25), (40, 60)])
    for section, k in ((0, 0), (2, 1), (7, 2), (None, None)):
        assert got[section][2:] == (counts[k], crossing[k])
    assert all(got[k] == (None, None, 0, 0) for k in (1, 3, 5)) and all(got[k][2:] == (0, 0) for k in (4, 6))
    assert got[0][:2] == (20, 40)


def test_empty_tables(empty):
    assert token_counts.token_counts(empty, BYTES).collect() == []
