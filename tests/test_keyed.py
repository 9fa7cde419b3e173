"""Keyed tables in buckets: what a batch writes, what versions name, replays and stopped commits."""

import random

import pytest

from corpusloom.sources import keyed, tables
from corpusloom.streaming import arrivals

SCHEMA = "k string, v int, created_at string, bucket int, seq int"


def entries(t, version):
    return {(e["bucket"], e["folder"]) for e in t._entries(version)}


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions_equal_whole_upserts(spark, tmp_path):
    """Columns are named as the table's own."""
    rng = random.Random(4)
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t", "k", 8, 3)
    want = spark.createDataFrame([], SCHEMA)
    for n in range(7):
        batch = spark.createDataFrame([(f"k{rng.randrange(12)}", rng.randrange(3), f"2024-01-0{n + 1}", 1, n) for _ in range(6)], SCHEMA)
        assert t.commit(batch, n)
        want = spark.createDataFrame(tables.upsert(want, batch, "k").collect(), SCHEMA)
        assert rows(t.read(batch.schema)) == rows(want)
        assert max(sum(b == x for x, _ in entries(t, n)) for b, _ in entries(t, n)) <= 3


def test_a_batch_writes_only_its_buckets(spark, tmp_path):
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t", "k", 16, 2)
    many = spark.createDataFrame([(f"k{i}", i, "d", 0, 0) for i in range(200)], SCHEMA)
    t.commit(many, 0)
    one = spark.createDataFrame([("k3", 999, "d", 0, 0)], SCHEMA)
    t.commit(one, 1)
    first, second = entries(t, 0), entries(t, 1)
    assert len(first) == 16 and first < second and len(second - first) == 1
    t.commit(spark.createDataFrame([("k3", 1000, "d", 0, 0)], SCHEMA), 2)
    third = entries(t, 2)
    assert len(third) == 16 and len(third & first) == 15  # the bucket with three entries was rewritten, the others are reused
    assert dict((r.k, r.v) for r in t.read(many.schema).collect())["k3"] == 1000
    assert dict((r.k, r.v) for r in t.read(many.schema, 1).collect())["k3"] == 999  # older versions stay
    assert keyed.KeyedTable(spark, f"file://{tmp_path}/t", "k", 99).buckets == 16


def test_replays_and_stopped_commits(spark, tmp_path, monkeypatch):
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t", "k", 4, 2)
    batch = lambda v: spark.createDataFrame([("a", v, "d", 0, 0)], SCHEMA)
    t.commit(batch(1), 0)
    assert not t.commit(batch(2), 0) and rows(t.read(batch(0).schema)) == [("a", 1, "d", 0, 0)]
    monkeypatch.setattr(t, "_compacted", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        t.commit(batch(3), 1)
    monkeypatch.undo()
    assert t.versions() == [0] and rows(t.read(batch(0).schema)) == [("a", 1, "d", 0, 0)]
    t.commit(batch(4), 1)
    gone = t.vacuum(1)
    assert len(gone) >= 1 and t.versions() == [1] and rows(t.read(batch(0).schema)) == [("a", 4, "d", 0, 0)]
    t.commit(batch(0).limit(0), 2)  # nothing came
    assert rows(t.read(batch(0).schema)) == [("a", 4, "d", 0, 0)]


def test_a_stream_into_buckets(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t", "k", 4, 2)
    schema = "k string, v int, created_at string"
    for n, lines in enumerate((['{"k":"a","v":1,"created_at":"x"}', '{"k":"b","v":1,"created_at":"x"}'], ['{"k":"a","v":1,"created_at":"y"}', '{"k":"b","v":2,"created_at":"y"}'])):
        (src / f"{n}.json").write_text("\n".join(lines))
        arrivals.upsert_buckets(spark.readStream.schema(schema).json(f"file://{src}"), t, f"file://{tmp_path}/cp").awaitTermination()
    assert rows(t.read(schema)) == [("a", 1, "x"), ("b", 2, "y")]


def test_an_empty_table(spark, tmp_path):
    assert keyed.KeyedTable(spark, f"file://{tmp_path}/none", "k").read(SCHEMA).count() == 0
