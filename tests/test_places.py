"""Places that repeat: what counts is told by the rows, not by the order in which they come."""

from pyspark.sql import functions as F

from corpusloom.operators import groups, joins, provenance
from corpusloom.sources import tables


def both_ways(spark, data, schema, function):
    found = [sorted(map(tuple, function(spark.createDataFrame(rows, schema).coalesce(1)).collect()), key=repr) for rows in (data, data[::-1])]
    assert found[0] == found[1]
    return found[0]


def test_overlay_ties(spark):
    data = [(1, 5, "a", "n/a"), (1, 5, "b", ""), (1, 4, "z", "kept"), (1, 6, "", "n/a"), (2, 1, "none", None)]
    got = both_ways(spark, data, "pos_key int, pos int, f string, g string", lambda d: joins.overlay(d, ["f", "g"]).select("pos_key", "f", "g"))
    assert got == [(1, "b", "kept"), (2, None, None)]


def test_history_ties(spark):
    data = [("c", "p", "x", 1, 1), ("c", "p", "w", 1, 1), ("c", "p ", None, 0, 0), ("d", "q", None, 1, 1), ("d", "q ", None, 1, 1)]
    got = both_ways(spark, data, "commit string, patch string, reverts_commit string, source_pos int, line int", lambda d: joins.merge_history(d).select("commit", "patch", "reverts_commit"))
    assert got == [("c", "p", "w"), ("d", "q", None)]


def test_last_per_commit_and_upsert_ties(spark):
    data = [("c", 1, "a"), ("c", 1, "b"), ("d", 0, "z"), ("d", 1, "y")]
    last = both_ways(spark, data, "commit string, pos int, v string", lambda d: provenance.last_per_commit(d, "pos").select("commit", "v"))
    assert last == [("c", "b"), ("d", "y")]
    got = both_ways(spark, data, "commit string, pos int, v string", lambda d: tables.upsert(d.limit(0), d, "commit", position="pos").select("commit", "v"))
    assert got == [("c", "b"), ("d", "y")]


def test_split_ties(spark):
    data = [("f", 1, "train", "a"), ("f", 1, "train", "b"), ("f", 2, "train", "c")]
    got = both_ways(spark, data, "fp string, pos int, assigned_split string, evaluation_tier string", lambda d: groups.reconcile_splits(d, "fp", "pos").select("pos", "assigned_split", "evaluation_tier"))
    assert {x[2] for x in got} == {"b"}


def test_starts_over_several_ranges(spark):
    import random

    rng = random.Random(1)
    keys = rng.sample(range(-50, 4000), 300)
    data = [(k, rng.randint(0, 5)) for k in keys]
    got = {r.k: r.start for r in groups.with_starts(spark.createDataFrame(data, "k long, n int"), "k", "n", 8).collect()}
    at, want = 0, {}
    for k, n in sorted(data):
        want[k] = at
        at += n
    assert got == want


def test_null_keys_are_spread_and_match_nothing(spark):
    ids = spark.createDataFrame([(i, None if i % 2 else "abcdef1") for i in range(400)], "i int, value string")
    commits = spark.createDataFrame([("abcdef1" + "0" * 33,), (None,)], "commit string")
    got = {r.i: r.resolved for r in joins.resolve_prefix(ids, commits).collect()}
    assert got == {i: None if i % 2 else "abcdef1" + "0" * 33 for i in range(400)}
    assert ids.where("value is null").select(joins.spread(F.col("value"), ids).alias("k")).distinct().count() > 150
