"""JSON text read by typed paths: malformed, odd and nested documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.lab import lab
from tests.test_scale import plan
from yearring.functions.documents import document, document_quality, document_shape, field, flattened, typed
from yearring.plans import performance

TEXTS = {
    "array": '[{"objectName": "T1", "columns": ["a", "b"], "n": 7}, {"objectName": "T2", "n": "x"}, 5, null]',
    "empty": "[]",
    "object": '{"objectName": "T3"}',
    "number": "5",
    "null": "null",
    "cut": '[{"objectName": "T4"',
    "blank": "",
    "none": None,
    "deep": '[{"objectName": "T5", "columns": [{"b": 1, "a": [1, {"z": null, "y": 2}]}]}]',
}


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id string, text string")


def test_paths(texts):
    doc = texts.select("id", document("text").alias("d"))
    got = {r.id: tuple(r)[1:] for r in doc.select("id", field("d", "$[0].objectName"), field("d", "$[0].n", "int"), field("d", "$[1].n", "int"), field("d", "$.objectName")).collect()}
    assert got["array"] == ("T1", 7, None, None) and got["object"] == (None, None, None, "T3")
    assert all(got[k] == (None,) * 4 for k in ("empty", "number", "cut", "blank", "none"))


def test_elements(texts):
    fields = {"objectName": ("$.objectName", "string"), "n": ("$.n", "int"), "columns": ("$.columns", "string")}
    rows = flattened(texts, "text", fields, ["id"], as_text=("columns",)).collect()
    got = sorted((tuple(r) for r in rows), key=str)
    deep = '[{"a":[1,{"y":2,"z":null}],"b":1}]'
    want = [("array", None, None, None)] * 2 + [("array", "T1", 7, '["a","b"]'), ("array", "T2", None, None), ("deep", "T5", None, deep)]
    assert got == sorted(want, key=str)


def test_kept_columns_may_have_the_names_of_the_exploded_side(texts):
    df = texts.select(F.col("id").alias("key"), F.col("text").alias("value"), F.lit(1).alias("pos"))
    rows = flattened(df, "value", {"objectName": ("$.objectName", "string")}, ["key", "pos"]).collect()
    assert {(r.key, r.pos) for r in rows} == {("array", 1), ("deep", 1)}


def test_quality_and_shape(texts, spark):
    (q,) = document_quality(texts, ["text"]).collect()
    assert tuple(q) == ("text", 9, 1, 2, 3, 3, 5)
    assert tuple(document_quality(texts.limit(0), ["text"]).first()) == ("text", 0, 0, 0, 0, 0, 0)
    shape = document_shape(spark.createDataFrame([('{"a": 1}',), ('{"a": 2.5, "b": ["x"]}',), ("{",)], "text string"), "text")
    assert shape.first()[0] == "OBJECT<a: DECIMAL(21,1), b: ARRAY<STRING>>"


def test_typed(texts):
    got = {r.id: r.t for r in texts.select("id", typed("text", "array<struct<objectName: string>>").alias("t")).collect()}
    assert [x.objectName for x in got["deep"]] == ["T5"] and got["empty"] == []
    assert [x and x.objectName for x in got["array"]] == ["T1", "T2", None, None]  # 5 is no struct
    assert all(got[k] is None for k in ("object", "cut", "none"))


def test_text_and_structs_give_the_same_report(spark, sf):
    """Structs written as text, none of it damaged."""
    here = lab(spark, sf)
    log, access = here.read("access_log"), here.read("access_history")
    names = ["direct_objects_accessed", "objects_modified"]
    as_text = access.withColumns({c: F.to_json(c) for c in names})
    for report in (performance.user_table_access, performance.lineage_modified):
        want = report(log, access, "2001-08-02 00:00:00", 900)
        assert report(log, as_text, "2001-08-02 00:00:00", 900).collect() == want.collect() != []


def test_other_queries_go_before_text_is_parsed(spark, sf):
    here = lab(spark, sf)
    text = plan(performance.user_table_access(here.read("access_log"), here.texts().read("open"), "2001-08-02 00:00:00"))
    assert text.index("variant_explode") < text.index("LeftSemi") and "BatchEvalPython" not in text
