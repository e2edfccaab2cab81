"""Language-model scores and the quality network."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import prose
from yearring.llm import lm_scoring, quality


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def brute_scores(rows, weights_of, tokens_all, known):
    """Scores by plain counting, given the fitted weights."""
    words, pairs = Counter(), Counter()
    for i, t in rows:
        if crc(i) % 7 != 2:
            found = tokens(t)
            words.update(found)
            pairs.update(zip([b"\n", *found], found))
    for i, t in rows:
        found, score, base = tokens(t), 0.0, 0.0
        for v, w in zip([b"\n", *found], found):
            a2, a1, a0 = weights_of(words[v])
            pair = pairs[v, w] / words[v] if words[v] else 0
            score += math.log10(a2 * pair + a1 * words[w] / tokens_all + a0 / (known + 1))
            base += math.log10((words[w] + 1) / (tokens_all + known + 1))
        yield i, len(found), sum(words[w] > 0 for w in found), base, score


def test_scores(nasty, monkeypatch):
    rows, df = nasty
    fitted = []
    fit = lm_scoring.fit_weights
    monkeypatch.setattr(lm_scoring, "fit_weights", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    got = lm_scoring.lm_scores(df).collect()
    training = [tokens(t) for i, t in rows if crc(i) % 7 != 2]
    n, v = sum(map(len, training)), len({w for t in training for w in t})
    assert {r.train_tokens for r in got} == {n}
    assert all(r.held_out == (crc(r.doc_id) % 7 == 2) for r in got)
    weights = fitted[0]
    assert np.allclose(weights.sum(axis=1), 1)
    rounded = lambda i, n, known, base, score: (i, n, known, round(base, 4), round(score, 4))
    want = Counter(rounded(*x) for x in brute_scores(rows, lambda c: weights[c.bit_length()], n, v))
    assert Counter(rounded(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got) == want


def test_weights_follow_the_histogram():
    """Where pairs predict tokens, the pair weight rises; where they don't, the word weight does."""
    level = lambda p: int(1 + round(-lm_scoring.STEPS * math.log2(p))) if p else 0
    cell = lambda bucket, pair, word: (bucket * lm_scoring.LEVELS + level(pair)) * lm_scoring.LEVELS + level(word)
    cells = np.array([cell(3, 0.5, 0.001), cell(3, 0, 0.001), cell(8, 0, 0.01), cell(8, 0, 0)])
    weights = lm_scoring.fit_weights(cells, np.array([90.0, 10.0, 80.0, 20.0]), 1e-6)
    assert weights[3, 0] > 0.8 and weights[8, 0] < 0.01 and weights[8, 1] > 0.7 and weights[8, 2] > 0.1
    assert (weights[9] == weights[8]).all() and weights[0, 0] == 0


def test_held_out_texts_are_scored_better_than_base(spark, sf):
    rows = lm_scoring.lm_scores(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_no_training_rows(spark):
    ids = [i for i in range(60) if crc(i) % 7 == 2]
    rows = lm_scoring.lm_scores(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in rows} == {(True, 3, 0, 0, 0.0)}


def labelled(n, seed=5):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        text, bad = prose(rng, rng.randrange(20, 300)), i % 4 == 0
        rows.append((i, " ".join(w + rng.choice(["###", "&&&"]) for w in text.split()) if bad else text))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = labelled(400)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.quality_scores(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    truth = dict(labels)
    assert len(out) == len(rows)
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_held_out_labels_are_never_read(spark):
    """Turning every held-out label round changes no score."""
    rows, labels = labelled(150)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - y if crc(i) % 5 == 0 else y) for i, y in labels]
    scores = [{r.doc_id: r.score for r in quality.quality_scores(df, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_whole_text_is_seen():
    """A mark at the very end of a long text moves the score as one at the start does."""
    rows, labels = labelled(200)
    model = quality.ByteCNN()
    model.train([t.encode() for _, t in rows], [y for _, y in labels])
    good = prose(random.Random(9), 40_000)
    bad = " ".join(w + "###" for w in prose(random.Random(8), 4_000).split())
    alone = model.score(good.encode())
    for text in (bad + " " + good, good + " " + bad):
        assert model.score(text.encode()) < alone


def test_convolution_by_hand():
    model = quality.ByteCNN()
    text = bytes(random.Random(2).randrange(256) for _ in range(700))
    codes = model.padded(text)
    windows = np.array([sum(model.table[j, codes[i + j]] for j in range(quality.WIDTH)) for i in range(len(text))])
    want = [np.maximum(windows[a : a + quality.CHUNK].max(axis=0) + model.bias, 0) for a in range(0, len(text), quality.CHUNK)]
    assert np.allclose(model.pooled(text), want, atol=1e-4)


def test_quality_of_nasty_rows(nasty, spark):
    rows, df = nasty
    labels = spark.createDataFrame([(300 + i, i % 2, None) for i in range(40)] + [(301, 1, 0), (None, 1, 0), (302, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_scores(df, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted for r in out)


@pytest.mark.parametrize("labels", [[], [(300, 1), (301, 1)]])
def test_without_both_classes(nasty, spark, labels):
    rows, df = nasty
    out = quality.quality_scores(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.5, 1)}


def test_labels_of_absent_rows_take_no_place(spark):
    """A slice of a labelled corpus: the sample comes from the rows that are here."""
    rows = [(100_000 + i, ("good words here " if i % 2 else "@@## $$ !! ") * 5) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(200_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    learn = labels["doc_id"].isNotNull()
    texts, known = quality.sample(df, labels, learn, "doc_id", "text", "quality", 30, 1 << 20)
    assert sorted(known) == [0] * 20 + [1] * 20
    with pytest.warns(UserWarning, match="untrained"):
        quality.sample(df, labels.filter("doc_id < 1000"), learn, "doc_id", "text", "quality", 30, 1 << 20)


def test_a_text_that_does_not_fit_is_passed_over(spark):
    """The others of both classes are still learned from; without any of a class there is an error instead of an untrained model."""
    rows = [(i, "long " * (400 if i < 30 else 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    learn = labels["doc_id"].isNotNull()
    texts, known = quality.sample(df, labels, learn, "doc_id", "text", "quality", 100, 1000)
    assert sorted(known) == [0] * 5 + [1] * 5 and all(len(t) == 20 for t in texts)
    with pytest.raises(ValueError, match="class"):
        quality.fit(df, labels.filter("doc_id < 30 OR quality = 1"), learn, max_bytes=1000)


def test_empty_tables(empty, spark):
    assert lm_scoring.lm_scores(empty).collect() == []
    assert quality.quality_scores(empty, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")).collect() == []
