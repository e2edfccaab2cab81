"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from checks.compare import _rows, oracle_connection
from tests.llm.conftest import SCHEMA, filled
from yearring.llm.parts import written
from yearring.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    result = oracle_connection(sf).execute(ORACLES[name])
    want = result.fetchall()
    assert want and _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows([d[0] for d in result.description], want)


def test_contract():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_stages_do_their_work(spark, sf, nasty):
    """Every stage but the last returns its input's columns, over rows of every odd kind."""
    rows, df = nasty
    docs, counts = df, [len(rows)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.dtypes == df.dtypes
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_planted_documents(spark, sf):
    """Copies, near copies and personal data planted among the documents go; the clean ones stay."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = docs.filter("length(text) BETWEEN 1000 AND 3000 AND lang = 'en'").orderBy("doc_id").limit(6).collect()
    rng, planted = random.Random(2), []
    for k, r in enumerate(clean[:3]):
        planted.append((10_000 + k, r.text.swapcase() if k else r.text.upper().lower().capitalize()))
        words = r.text.split(" ")
        words[rng.randrange(len(words))] = "altered"
        planted.append((20_000 + k, " ".join(words)))
    planted.append((30_000, clean[5].text[:500] + " write to someone.else@mail.example.org or +1 (212) 555-0123 " + clean[4].text[300:900]))
    extra = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in planted], docs.schema)
    table = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        table = written(stage(spark, table, sf), name)
    left = {r.doc_id: r.text for r in table.collect()}
    groups = [{clean[k].doc_id, 10_000 + k, 20_000 + k} for k in range(3)]
    assert all(len(g & set(left)) == 1 for g in groups)
    assert {r.doc_id for r in clean[3:]} <= set(left)
    assert "<EMAIL>" in left[30_000] and "<PHONE>" in left[30_000] and "someone.else" not in left[30_000]


def test_pipeline_runs(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.filter("offset + length > 4096").count() == 0 and out.count() > 0


def test_empty_documents(spark, sf):
    docs = spark.createDataFrame(filled([]), SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), name)
    assert docs.count() == 0
