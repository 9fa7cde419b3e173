"""The schema compiler against values one by one."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import schemas


def errors(spark, schema, *values, **more):
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    got = df.select("i", schemas.compile_schema(schema, F.parse_json("j"), **more).alias("e")).orderBy("i").collect()
    return [sorted(r.e) for r in got]


CASES = [
    ({"type": ["string", "null"]}, ["a", None, 1, [], {}], [[], [], ["$ type"], ["$ type"], ["$ type"]]),
    ({"type": "integer"}, [1, 1.0, 1.5, True, "1"], [[], [], ["$ type"], ["$ type"], ["$ type"]]),
    ({"type": "number"}, [1, 1e300, "1", False], [[], [], ["$ type"], ["$ type"]]),
    ({"enum": ["a", 1, None, {"x": [1]}]}, ["a", 1.0, None, {"x": [1]}, "b", {"x": [2]}], [[], [], [], [], ["$ enum"], ["$ enum"]]),
    ({"pattern": "b+"}, ["abc", "ac", 5], [[], ["$ pattern"], []]),
    ({"minLength": 2, "maxLength": 3}, ["é", "éé", "éééé", 7], [["$ minLength"], [], ["$ maxLength"], []]),
    ({"minimum": 1, "exclusiveMaximum": 3}, [0, 1, 3, "x"], [["$ minimum"], [], ["$ exclusiveMaximum"], []]),
    ({"format": "date-time"}, ["2024-02-29T00:00:00Z", "2024-02-29T00:00:00", "2023-02-29T00:00:00Z", 4], [[], ["$ format"], ["$ format"], []]),
    ({"format": "uri"}, ["urn:a:b", "https://x y", "x/y"], [[], ["$ format"], ["$ format"]]),
    ({"uniqueItems": True}, [[1, 1.0], ["1", 1], [{"a": 1, "b": 2}, {"b": 2, "a": 1}], 5], [["$ uniqueItems"], [], ["$ uniqueItems"], []]),
    ({"items": {"items": {"type": "string"}}}, [[["a"], ["b", 2]], [1], "x"], [["$[1][1] type"], [], []]),
    ({"additionalProperties": {"minimum": 2}, "properties": {"a": {}}}, [{"a": 0, "b": 2}, {"b": 1}], [[], ["$.b minimum"]]),
    ({"properties": {"odd name.x": {"type": "null"}}}, [{"odd name.x": 1}], [["$.odd name.x type"]]),
    ({"required": ["a", "b"]}, [{"a": None}, {}, 3], [["$.b required"], ["$.a required", "$.b required"], []]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["a", 5, 4], [[], [], ["$ anyOf"]]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 5}]}, [1, 5, "x"], [[], ["$ oneOf"], []]),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, [0, 1, 3], [["$ minimum"], [], ["$ maximum"]]),
    ({"not": {"type": "string"}}, ["a", 1], [["$ not"], []]),
    ({"properties": {"a": False}}, [{"a": 1}, {"b": 1}], [["$.a forbidden"], []]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_keywords(spark, case):
    schema, values, want = CASES[case]
    assert errors(spark, schema, *values) == want


def test_references(spark):
    tree = {"$defs": {"a/b": {"type": "object", "properties": {"v": {"type": "integer"}, "next": {"$ref": "#/$defs/a~1b"}}}}, "$ref": "#/$defs/a~1b"}
    deep = lambda n: {"v": 1} if n == 0 else {"v": 1, "next": deep(n - 1)}
    assert errors(spark, tree, deep(2), {"next": {"v": "x"}}, deep(3), depth=3) == [[], ["$.next.v type"], ["$.next.next.next depth"]]


@pytest.mark.parametrize("schema", [{"contains": {}}, {"format": "email"}, {"$ref": "#/$defs/none"}, {"$ref": "other.json"}, {"items": {"if": {}}}, {"properties": {"a": {"maxContains": 1}}}])
def test_what_is_not_known_raises(spark, schema):
    with pytest.raises(ValueError):
        schemas.compile_schema(schema, F.parse_json(F.lit("1")))


def test_checks_name_rows(spark):
    df = spark.createDataFrame([(1, "{}"), (2, "nope"), (3, None), (4, "[]")], "k int, j string")
    got = sorted((r.key, r.message) for r in schemas.schema_checks(df, {"type": "object"}, "k", "j").collect())
    assert got == [("2", "not JSON"), ("3", "not JSON"), ("4", "$ type")]
