import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import ledger, patches
from corpusloom.operators import groups, joins, schemas

FAILURES = (PySparkException, Py4JJavaError)

DIFF = """diff --git a/docs/a.md b/docs/a.md
index 111..222 100644
--- a/docs/a.md
+++ b/docs/a.md
@@ -1 +1 @@
-old
+new
diff --git a/src/ops/kernel.cu b/src/ops/kernel.cu
index 333..444 100644
--- a/src/ops/kernel.cu
+++ b/src/ops/kernel.cu
@@ -1,3 +1,3 @@ void f()
   keep();
-  old_path();
+  new_path();
 }
"""


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "v string").select(*columns).first()


def test_patch_filter_and_preimage(spark):
    r = one(spark, DIFF, patches.code_only(F.col("v")).alias("c"), patches.preimage(F.col("v")).alias("p"))
    assert "docs/a.md" not in r.c and "new_path" in r.c
    assert r.p == "### src/ops/kernel.cu\n@@ -1,3 +1,3 @@ void f()\n   keep();\n-  old_path();\n }"
    r = one(spark, "", patches.code_only(F.col("v")).alias("c"), patches.preimage(F.col("v")).alias("p"))
    assert (r.c, r.p) == ("", "")


def test_fingerprint_ignores_what_varies(spark):
    other = DIFF.replace("333..444", "555..666").replace("@@ -1,3 +1,3 @@", "@@ -9,3 +9,3 @@")
    fp = lambda v: one(spark, v, patches.fingerprint(F.col("v"), F.lit("m"), F.lit("f"), F.lit("o")).alias("x")).x
    assert fp(DIFF) == fp(other) != fp(DIFF.replace("keep", "kept"))


def test_prefixes(spark):
    c = spark.createDataFrame([("abcdef0" + "1" * 33,), ("abcdef1" + "1" * 33,), ("abcdef1" + "2" * 33,)], "commit string")
    v = spark.createDataFrame([("ABCDEF0",), ("deadbee",), ("abc",), ("n/a",), ("f" * 40,), (None,)], "value string")
    got = {r.value: r.resolved for r in joins.resolve_prefix(v, c).collect()}
    assert got == {"ABCDEF0": "abcdef0" + "1" * 33, "deadbee": None, "abc": None, "n/a": None, "f" * 40: "f" * 40, None: None}
    with pytest.raises(FAILURES, match="ambiguous"):
        joins.resolve_prefix(spark.createDataFrame([("abcdef1",)], "value string"), c).collect()


def test_history_conflict(spark):
    h = spark.createDataFrame([("c", "p", None, 0, 0), ("c", "q", None, 1, 0)], "commit string, patch string, reverts_commit string, source_pos int, line int")
    with pytest.raises(FAILURES, match="conflicting"):
        joins.merge_history(h).collect()


def test_pinned_latest_record(spark):
    r = spark.createDataFrame([("s", "r1", "t1", "x"), ("s", "r2", "t2", "y"), ("t", "r3", "t1", "z"), ("t", "r4", "t2", "z")], "source_id string, record_id string, created_at string, sha256 string")
    reg = spark.createDataFrame([("s", "x"), ("t", "z")], "source_id string, sha256 string")
    assert {x.source_id: x.record_id for x in joins.latest_record(r, reg).collect()} == {"s": "r1", "t": "r4"}


def test_clean_and_secrets(spark):
    for v, want in ((" N/A ", ""), ("not-run", "not-run"), (" x ", "x"), (None, "")):
        assert one(spark, v, ledger.clean(F.col("v")).alias("c")).c == want
    assert one(spark, "k AKIA" + "A" * 16, ledger.secrets(F.col("v")).alias("s")).s == ["aws_key"]
    assert one(spark, "ghp_" + "a" * 36, ledger.secrets(F.col("v")).alias("s")).s == []
    assert one(spark, "ghp_" + "a" * 36, ledger.secrets(F.col("v"), ledger.STRICT_SECRETS).alias("s")).s == ["used_token"]


def test_gate_modes(spark):
    d = spark.createDataFrame([("a", 100.0, 98.0, 0.0), ("a", 100.0, 98.8, 0.0), ("b", 100.0, 99.5, 4.0), ("b", 100.0, 99.5, 4.0)], "k string, base_ms double, ms double, tok_gain double")
    by = lambda **o: {r.k: r.accepted for r in groups.accept_gate(d, ["k"], **o).collect()}
    assert by() == {"a": True, "b": True} and by(mode="each") == {"a": False, "b": True} and by(mode="all", min_pct=2.0) == {"a": False, "b": False}


def test_windows_need_enough(spark):
    d = spark.createDataFrame([([1, 2, 3], 0), ([4, 5], 3)], "ids array<int>, start long")
    assert groups.windows(d, "ids", "start", 4, 1).first().ids == [1, 2, 3, 4]
    with pytest.raises(FAILURES, match="too few"):
        groups.windows(d, "ids", "start", 4, 2).collect()


def test_unknown_schema_keyword(spark):
    with pytest.raises(ValueError):
        schemas.compile_schema({"contains": []}, F.col("v"))
    d = spark.createDataFrame([("1", '{"a":[1,1],"b":"x","c":true}'), ("2", "{"), ("3", '{"a":[1],"b":"xx","d":"2020-01-01T00:00:00Z"}')], "k string, j string")
    schema = {"type": "object", "required": ["b"], "properties": {"a": {"type": "array", "uniqueItems": True, "minItems": 1}, "b": {"type": "string", "minLength": 2}, "c": {"const": False}, "d": {"type": "string", "format": "date-time"}}}
    got = {(r.key, r.message) for r in schemas.schema_checks(d, schema, "k", "j").collect()}
    assert got == {("1", "$.a uniqueItems"), ("1", "$.b minLength"), ("1", "$.c const"), ("2", "not JSON")}


def test_streams(spark, tmp_path):
    from corpusloom.streaming import arrivals

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"sha256":"x","created_at":"2026-01-01T00:00:00","v":1}\n{"sha256":"x","created_at":"2026-01-01T00:00:01","v":1}\n{"sha256":"y","created_at":"2026-01-01T00:00:02","v":2}\n')
    s = arrivals.new_records(spark, f"file://{src}", "sha256 string, created_at timestamp, v int")
    arrivals.upsert_into(s, f"file://{tmp_path}/t", "sha256", f"file://{tmp_path}/c").awaitTermination()
    assert sorted(r.sha256 for r in arrivals.current(spark, f"file://{tmp_path}/t").collect()) == ["x", "y"]
