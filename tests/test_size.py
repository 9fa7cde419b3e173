"""What must not grow with the tables: broadcasts, tasks and pairs."""

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import rows, spelling
from corpusloom.operators import episodes, joins
from corpusloom.plans import episode_queries, evidence_queries, ledger_queries, registry, source_queries
from corpusloom.sources import tables


def test_texts_of_parts_are_never_broadcast(spark, sf):
    plan = episode_queries.candidates(spark, sf)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [pos" in plan and "BroadcastHashJoin [pos" not in plan


def test_no_event_is_built_where_none_is_read(spark, sf):
    made = episode_queries.made(spark, sf)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    told = episodes.INSTRUCTIONS["judgment"]
    assert told in plan(made.select("events")) and told not in plan(made.select("episode_id", "outcome"))


def test_patches_are_dealt_over_tasks_by_their_number(spark, sf, monkeypatch):
    """One file of few bytes holds many parts, and each takes long."""
    monkeypatch.setattr(tables.shared_out, "__defaults__", (50,))
    assert tables.shared_out(registry.table(spark, sf, "part"), "p_partkey").rdd.getNumPartitions() == 4
    assert "REPARTITION_BY_NUM" in ledger_queries.patch_text(spark, sf)._jdf.queryExecution().executedPlan().toString()


SLOTS = [(1, "3", "5", "c3_05"), (1, "4", "5", "c4_05"), (2, "3", "05", "c3_05"), (3, None, "5", "x"), (4, "", "7", "C3_05"), (5, "x", "9", None), (6, "3", "5", "5"), (7, "9", "9", "zz")]
SAID = [(at, at % 3, about, cycle, text) for at, (about, cycle, text) in enumerate([
    ("5", "", "b"), ("C3_05", "3", "a"), ("c3_05", "", " "), ("c3_05", None, "n/a"), (" cc3_05 ", " 3 ", "d"), ("5", "4", "e"), ("none", "", "f"), (None, "3", "g"), ("9", "", None), ("5", "", "b"), ("c3_05", "7", "h"), ("x", "", "i")])]


def test_corrections_by_group_are_those_by_pair(spark):
    """Keys with several cycles, names that several candidates share, equal rows, null cycles and empty values."""
    c = spark.createDataFrame(SLOTS, "pos_key int, cycle string, candidate string, `order` string")
    k = spark.createDataFrame([*SAID, *SAID[:5]], "pos int, line int, about string, in_cycle string, t string")
    pairs = joins.corrections_for(c, k)
    got = lambda df: sorted(map(tuple, df.collect()))
    assert got(joins.correction_counts(c, k)) == got(pairs.groupBy("pos_key").agg(F.count("*"), F.min("pos"), F.max("pos")))
    assert got(joins.corrected(c, k, ["t", "about"])) == got(joins.overlay(pairs, ["t", "about"]))
    assert got(joins.correction_reasons(c, k, ["t", "about"])) == got(joins.reasons(pairs, ["t", "about"]))
    assert got(joins.correction_reasons(c, k, ["t"], "line")) == got(joins.reasons(pairs, ["t"], pos="line"))


def test_reasons_are_kept_in_chunks(spark, monkeypatch):
    """Chunks of two: corrections of other lists fall before, between and after them, with equal places and null ones; no written list is longer."""
    kept, most = tables.saved, []

    def saved(df, path):
        out = kept(df, path)
        most.extend(out.agg(F.max(F.size(c))).first()[0] or 0 for c, kind in out.dtypes if kind.startswith("array<struct"))
        return out

    monkeypatch.setattr(tables, "saved", saved)
    monkeypatch.setattr(joins, "CHUNK", 2, raising=False)
    more = [(p, 0, about, "", f"{about} {p}") for p in range(0, 40, 3) for about in ("5", "c3_05")] + [(None, 1, "5", "", "none"), (None, 1, "c3_05", "3", "none"), (-5, 1, "5", "", "first"), (99, 1, "5", "", "last")]
    c = spark.createDataFrame(SLOTS, "pos_key int, cycle string, candidate string, `order` string")
    k = spark.createDataFrame([*SAID, *more], "pos int, line int, about string, in_cycle string, t string").repartition(3)
    got = lambda df: sorted(map(tuple, df.collect()))
    assert got(joins.correction_reasons(c, k, ["t", "about"])) == got(joins.reasons(joins.corrections_for(c, k), ["t", "about"]))
    assert most and max(most) <= 2


def test_pairs_of_candidates_and_corrections_are_not_made(spark):
    """1500 candidates share a name that 1500 corrections give."""
    c = spark.range(1500).selectExpr("id as pos_key", "'3' as cycle", "cast(id + 100 as string) as candidate", "'c3_05' as `order`")
    k = spark.range(1500).selectExpr("id as pos", "'C3_05' as about", "if(id % 2 = 0, '', '3') as in_cycle", "'v' as t")
    for df in (joins.correction_counts(c, k), joins.corrected(c, k, ["t"]), joins.correction_reasons(c, k, ["t"])):
        df.write.format("noop").mode("overwrite").save()
        assert df.count() == 1500
        assert most_rows(df) < 10_000


def most_rows(df):
    """The most rows that an operator of the plan gave."""
    plan, seen = [], []
    df.collect()
    plan.append(df._jdf.queryExecution().executedPlan())
    while plan:
        p = plan.pop()
        for child in [x for x in (p.finalPhysicalPlan() if "AdaptiveSparkPlan" in p.nodeName() else None, p.plan() if "QueryStage" in p.nodeName() else None) if x is not None]:
            plan.append(child)
        plan += [p.children().apply(i) for i in range(p.children().size())]
        if p.metrics().contains("numOutputRows"):
            seen.append(p.metrics().apply("numOutputRows").value())
    return max(seen)


def test_vocabularies_are_never_broadcast(spark, monkeypatch):
    plans = []
    kept = rows.settled

    def settled(df, path):
        plans.append(df)
        return kept(df, path)

    monkeypatch.setattr(rows, "settled", settled)
    text = " ".join(["letters lettters letter lettersx other"] * 3)
    found = spelling.variants(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"))
    assert found.count() > 0
    for df in [*plans, found]:
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().sparkPlan().toString()


def test_candidates_are_shuffled_once(spark, sf, monkeypatch):
    """The wide rows of the ledger meet their commits in one join by key; sources, splits and corrections that are few are sent to them."""
    plans = {}
    kept = tables.saved

    def saved(df, path):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, path)

    monkeypatch.setattr(tables, "saved", saved)
    found = source_queries.wide_candidates(spark, sf)
    plans["found"] = found._jdf.queryExecution().executedPlan().toString()
    joins_of = lambda p: (p.count("SortMergeJoin"), p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning"))
    assert joins_of(plans["fields"]) == (0, 0) and joins_of(plans["found"]) == (0, 0)
    # by key: what the history tells of all values, and the rows; this history is small enough to be sent to the values
    assert joins_of(plans["linked"]) == (1, 2)


def test_commits_told_at_once_are_those_of_each_value(spark):
    """Whole ids, prefixes, an exact prefix of another, unknown ids, and values that are none; one raises."""
    a, b = "a" * 40, "a" * 8 + "b" * 32
    h = spark.createDataFrame([(a, "p", "s1", None), (b, "q", "s2", a), ("c" * 7, "r", "s3", b), ("c" * 7 + "d", "t", "s4", None)], "commit string, patch string, source_id string, reverts_commit string")
    values = [(a, b), ("aaaaaaaab", a[:9]), ("C" * 7, None), ("cccccccd", " n/a "), ("e" * 40, "f" * 9), ("", "aaaaaa"), (None, "E" * 40)]
    rows_ = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "key int, x string, y string")
    told = joins.told_by_history(rows_, h, "key", {"x": ["patch", "source_id"], "y": ["source_id", "reverts_commit"]}).select(F.col("key"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    got = rows_.join(told, "key", "left").select("key", joins.told_commit("_x", "x").alias("x"), joins.told_commit("_y", "y").alias("y"), "_x.patch", "_x.source_id", F.col("_y.source_id").alias("of_y"), "_y.reverts_commit")
    one = lambda c: {r.key: r.resolved for r in joins.resolve_prefix(rows_, h, c).collect()}
    found = {r.key: r for r in got.collect()}
    assert {k: r.x for k, r in found.items()} == one("x") and {k: r.y for k, r in found.items()} == one("y")
    assert [(found[k].patch, found[k].source_id) for k in range(5)] == [("p", "s1"), ("q", "s2"), ("r", "s3"), ("t", "s4"), (None, None)]
    assert (found[0].of_y, found[0].reverts_commit, found[1].of_y) == ("s2", a, "s1")
    bad = spark.createDataFrame([(1, "a" * 8, None)], "key int, x string, y string")
    told = joins.told_by_history(bad, h, "key", {"x": ["patch"]}).withColumnRenamed("x", "_x")
    with pytest.raises(Exception, match="ambiguous prefix"):
        bad.join(told, "key").select(joins.told_commit("_x", "x")).collect()


def test_an_evaluation_is_built_once(spark, sf):
    """Prompts and answers come from one pass over the episodes, not from two that are joined; what is published has no label."""
    for query in (evidence_queries.evaluation_fields, episode_queries.eval_exports):
        plan = query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 1
    made = episode_queries.made(spark, sf)
    public, private = episodes.evaluation(made)
    assert not {"reference_answer", "outcome", "required_snapshot_refs"} & set(public.columns) and not {"prompt", "rubric"} & set(private.columns)
    both = public.join(private, "id").select("id", F.md5("prompt").alias("p"), F.md5("reference_answer").alias("a"), "outcome")
    assert sorted(map(str, both.collect())) == sorted(map(str, episodes.evaluated(made).select("id", F.md5("prompt").alias("p"), F.md5("reference_answer").alias("a"), "outcome").collect()))
