"""Constraints as queries: each gives rows (check, key, message) for what breaks it, and all are gathered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.episodes import ALLOWED, PREIMAGE


def broken(df: DataFrame, check: str, key: Column, bad: Column, message: Column | str) -> DataFrame:
    m = F.lit(message) if isinstance(message, str) else message
    return df.where(F.coalesce(bad, F.lit(True))).select(F.lit(check).alias("check"), key.cast("string").alias("key"), m.alias("message"))


def gathered(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def contiguous(events: Column) -> Column:
    n = F.size(events)
    want = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(events, lambda e: e["sequence"].cast("int")) == want


def view_checks(episodes: DataFrame, exact: Column | None = None) -> DataFrame:
    """Sequence, set algebra of the view, leakage by information class and by label, patch targets, duplicate event ids. Where exact holds (by default
    everywhere) the target of an implementation is a unified diff, and the source before it is among the inputs."""
    exact = F.lit(True) if exact is None else exact
    key, ev = F.col("episode_id"), F.col("events")
    i, t, w = (F.col(f"view.{x}_event_ids") for x in ("input", "target", "withheld"))
    all_ids = F.transform(ev, lambda e: e["event_id"])
    inputs = F.filter(ev, lambda e: F.array_contains(i, e["event_id"]))
    classes = F.transform(inputs, lambda e: e["information_class"])
    targets = F.filter(ev, lambda e: F.array_contains(t, e["event_id"]))
    build = F.col("task_view") == "implementation"
    rules = [
        ("sequence", ~contiguous(ev), "events aren't numbered from 0"),
        ("event ids", F.size(F.array_distinct(all_ids)) != F.size(all_ids), "an event id occurs twice"),
        ("input and target", F.arrays_overlap(i, t), "an event is input and target"),
        ("input and withheld", F.arrays_overlap(i, w), "an event is input and withheld"),
        ("known ids", F.size(F.array_except(F.array_union(F.array_union(i, t), w), all_ids)) > 0, "the view names an unknown event"),
        ("leak", F.col("view.candidate_generation") & (F.size(F.array_except(classes, F.array(*[F.lit(a) for a in ALLOWED]))) > 0), "results are among the inputs"),
        ("label", ~F.col("view.result_label_visible") & F.array_contains(classes, "disposition_label"), "the label is among the inputs"),
        ("patch", build & ~F.exists(targets, lambda e: (e["event_type"] == "patch") & (~exact | F.contains(e["payload"], F.lit("diff --git")))), "no patch is asked for"),
        ("preimage", build & exact & ~F.exists(inputs, lambda e: (e["event_type"] == "observation") & F.contains(e["payload"], F.lit(PREIMAGE))), "the source before the patch isn't given"),
    ]
    # one pass over the episodes, whatever the number of checks
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(check).alias("check"), F.lit(message).alias("message"))) for check, bad, message in rules]))
    return episodes.select(key.cast("string").alias("key"), F.inline(found)).select("check", "key", "message")


def outcome_checks(episodes: DataFrame, history: DataFrame) -> DataFrame:
    """A rejected commit has a restoration, known as such, that reverts it; and no restoration is a candidate."""
    h = history.select(F.col("commit").alias("_c"), F.col("kind").alias("_kind"), F.col("reverts_commit").alias("_of"))
    e = episodes.where((F.col("outcome.disposition") == "rejected") & F.col("outcome.candidate_commit").isNotNull()).join(h, F.col("outcome.restoration_commit") == F.col("_c"), "left")
    key = F.col("episode_id")
    undone = history.where("kind = 'restoration'").select(F.col("commit").alias("_u")).distinct()
    taken = episodes.where(F.col("outcome.candidate_commit").isNotNull()).join(undone, F.col("outcome.candidate_commit") == F.col("_u"), "left_semi")
    return gathered(
        broken(taken, "revert as candidate", key, F.lit(True), "a revert is taken for a candidate"),
        broken(e, "restoration", key, F.col("_c").isNull(), "no restoration is known"),
        broken(e, "restoration kind", key, F.col("_c").isNotNull() & (F.col("_kind") != "restoration"), "the commit isn't a restoration"),
        broken(e, "restoration edge", key, F.col("_c").isNotNull() & ~F.col("_of").eqNullSafe(F.col("outcome.candidate_commit")), "it reverts another commit"),
    )
