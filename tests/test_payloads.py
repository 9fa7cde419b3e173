"""Payload texts against Python's own printing."""

import json

import pytest

from corpusloom.functions.payloads import payload_text


def test_byte_for_byte(spark):
    values = ["plain", "line\nbreak \"q\" é", 1, 1.0, 1e100, 1e-7, 12345678901234567890123, -0.0, True, None, [], {}, [[], {}], {"b": {"d": [1.5, {"z": None}], "c": "ü\\"}, "a": [1, 2]}, {"ﬁ": 1, "é": 2, "A": 3, "a": 4}, "", " "]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(99, None)], "i int, j string")
    got = {r.i: r.said for r in df.select("i", payload_text("j").alias("said")).collect()}
    assert got == {i: v if isinstance(v, str) else json.dumps(v, sort_keys=True, ensure_ascii=False, indent=2) for i, v in enumerate(values)} | {99: None}
    with pytest.raises(Exception, match="Expecting"):
        spark.createDataFrame([("{oops",)], "j string").select(payload_text("j")).collect()
