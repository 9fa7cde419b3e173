"""Episodes: nested event sequences of four views of a candidate, and their exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import ledger
from corpusloom.operators.joins import ordered_lookup

INPUT, TARGET, HIDDEN = "input", "target", "withheld"
# Information classes that must not be among the inputs of candidate generation, and those that may.
ALLOWED = ["task_context", "pre_candidate_evidence"]
INSTRUCTIONS = {
    "diagnosis": "Diagnose one falsifiable candidate from the evidence before it.",
    "implementation": "Implement the declared candidate in the given source context as a unified diff.",
    "judgment": "Judge the candidate from the evidence of correctness and of performance at each point.",
    "orchestration_reporting": "Choose the next action of the campaign after a decision.",
}
#: How the source before a change is introduced.
PREIMAGE = "Source hunks before the change"
#: Columns of candidates that their episodes carry where they are there.
CARRIED = ("architectures", "snapshot_refs", "source_ids", "limitations", "review_status", "preference")
# What an evaluation is scored by.
RUBRIC = ["contract correctness", "evidence calibration", "architecture scope", "appropriate verification"]


def event(role: str, actor: str, kind: str, information: str, payload: Column, refs: Column, when: Column | None = None) -> Column:
    """An event with the roles it has in its view (joined by plus signs); null where it doesn't occur."""
    e = F.struct(F.lit(role).alias("role"), F.lit(actor).alias("actor"), F.lit(kind).alias("event_type"), F.lit(information).alias("information_class"), payload.cast("string").alias("payload"), F.array_distinct(refs).alias("evidence_refs"))
    return e if when is None else F.when(when, e)


def sequence(*events: Column) -> Column:
    """The events that occur, numbered from 0: struct<event_id, sequence, role, ...>."""
    return F.transform(F.array_compact(F.array(*events)), lambda e, i: F.struct(F.format_string("e%03d", i).alias("event_id"), i.alias("sequence"), *[e[c].alias(c) for c in ("role", "actor", "event_type", "information_class", "payload", "evidence_refs")]))


def ids(events: Column, role: str) -> Column:
    return F.transform(F.filter(events, lambda e: F.contains(e["role"], F.lit(role))), lambda e: e["event_id"])


def results(role: str, ref: Column) -> list[Column]:
    """Validation, measurement and correction events, as far as a candidate has them."""
    has = lambda c: F.nullif(F.col(c), F.lit(""))
    checks = F.concat_ws("; ", F.concat(F.lit("Compile: "), has("compile_result")), F.concat(F.lit("Oracle: "), has("oracle_result")))
    measured = F.concat_ws("\n", F.concat(F.lit("Public Op: "), has("public_candidate")), F.concat(F.lit("Program/Engine: "), has("program_result")), F.concat(F.lit("Unaffected controls: "), has("seams")), F.concat(F.lit("Engine sentinels: "), has("sentinels")))
    return [
        event(role, "tool", "validation", "post_candidate_result", checks, ref, checks != ""),
        event(role, "tool", "measurement", "post_candidate_result", measured, ref, measured != ""),
        event(role, "evaluator", "validation", "post_candidate_result", F.col("correction_text"), F.col("correction_refs"), F.col("correction_text") != ""),
    ]


def views(terminal: Column) -> dict[str, tuple[Column, Column, bool, bool]]:
    """View name -> (condition, events, candidate generation, label visible) over the columns of a candidate."""
    ref, history = F.array("ledger_ref"), F.array("history_ref")
    fenced = lambda c: F.concat(F.lit("```diff\n"), c, F.lit("\n```"))
    said = ledger.decision_sentence(F.col("disposition"), F.col("reason"), F.col("restoration_commit"))
    told = lambda label, c, end=".": F.concat(F.lit(label), F.nullif(F.col(c), F.lit("")), F.lit(end))
    order = lambda view: event(INPUT, "system", "instruction", "task_context", F.lit(INSTRUCTIONS[view]), ref)
    context = event(INPUT, "user", "context", "task_context", F.col("context"), ref)
    before = event(INPUT, "tool", "observation", "task_context", F.concat(F.lit(f"{PREIMAGE}:\n"), fenced(F.col("preimage"))), history, F.col("preimage") != "")
    undone = event(HIDDEN, "tool", "restoration", "restoration", F.concat(F.lit("Restored by "), "restoration_commit", F.lit(".")), ref, F.col("restoration_commit").isNotNull())
    decided = lambda role: event(role, "assistant", "decision", "disposition_label", said, ref)
    both = f"{TARGET}+{HIDDEN}"
    why = F.concat_ws(" ", told("Mechanism: ", "mechanism"), told("Hypothesis: ", "hypothesis"), told("Expected: ", "prediction"), told("Reject if: ", "rejection"))
    shown = F.when(F.col("patch") != "", fenced(F.col("patch"))).otherwise(F.concat(F.lit("Candidate "), "order", F.lit(": "), "mechanism", F.lit(".")))
    action = F.when(F.col("disposition") == "accepted", "Retain the source, close the cycle and collect a new baseline.").when(terminal, "Verify the source, freeze the ledger without a win and consolidate.").otherwise("Restore, record the evidence and take the next slot.")
    return {
        "diagnosis": (
            (F.col("public_baseline") != "") & ((F.col("hypothesis") != "") | (F.col("prediction") != "")),
            sequence(order("diagnosis"), context, before, event(INPUT, "tool", "measurement", "pre_candidate_evidence", F.concat(F.lit("Baseline: "), "public_baseline"), ref), event(both, "assistant", "technical_rationale", "candidate_artifact", why, ref), event(HIDDEN, "assistant", "patch", "candidate_artifact", fenced(F.col("patch")), history, F.col("patch") != ""), *results(HIDDEN, ref), decided(HIDDEN)),
            True, False,
        ),
        "implementation": (
            (F.col("patch") != "") & (F.col("preimage") != "") & F.col("candidate_commit").isNotNull(),
            sequence(order("implementation"), context, event(INPUT, "tool", "observation", "pre_candidate_evidence", why, ref), before, event(both, "assistant", "patch", "candidate_artifact", fenced(F.col("patch")), history), event(both, "assistant", "tool_decision", "candidate_artifact", F.lit("Build, run the oracle at affected shapes, then measure; run wider checks only if these pass."), ref), *results(HIDDEN, ref), decided(HIDDEN), undone),
            True, False,
        ),
        "judgment": (F.lit(True), sequence(order("judgment"), context, event(INPUT, "assistant", "patch", "candidate_artifact", shown, history), *results(INPUT, ref), decided(both), undone), False, False),
        "orchestration_reporting": ((F.col("disposition") == "accepted") | terminal, sequence(order("orchestration_reporting"), decided(INPUT), event(both, "assistant", "report", "report", action, ref), undone), False, True),
    }


def view_names(candidates: DataFrame, terminal: Column) -> DataFrame:
    """The candidates with task_view, a row for each view that they have; no event is built."""
    names = F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, (when, *_) in views(terminal).items()]))
    return candidates.withColumn("task_view", F.explode(names))


def described(events: Column) -> Column:
    """Events as text, a line each with all of their fields, for digests and comparisons."""
    one = lambda e: F.concat_ws("|", *[e[c].cast("string") for c in ("event_id", "sequence", "role", "actor", "event_type", "information_class")], F.array_join(e["evidence_refs"], ","), e["payload"])
    return F.array_join(F.transform(events, one), "\n")


def episodes(candidates: DataFrame, terminal: Column) -> DataFrame:
    """One to four episodes per candidate: episode_id, family_id, lineage_id, task_view, split, events, view and outcome, in one pass.

    Names are exploded and events built after that, so a query that reads no event builds none.
    """
    made = views(terminal)
    each = candidates.withColumn("_v", F.explode(F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, (when, *_) in made.items()]))))
    built = F
    for name, (_, events, *_) in made.items():
        built = built.when(F.col("_v") == name, events)
    each = each.withColumn("_e", built)
    generation, visible = (F.col("_v").isin([name for name, view in made.items() if view[k]]) for k in (2, 3))
    lineage = F.coalesce(F.nullif(F.concat_ws("+", "candidate_commit", "restoration_commit"), F.lit("")), F.concat_ws(":", "campaign_id", "cycle", "order"))
    e = F.col("_e")
    return each.select(
        F.concat_ws("-", F.lit("auto"), ledger.slug(F.col("campaign_id")), ledger.slug(F.col("order")), "_v").alias("episode_id"), F.concat(F.lit("family-auto-"), F.substring("fingerprint", 1, 20)).alias("family_id"), lineage.alias("lineage_id"),
        F.concat(F.lit("campaign-auto|"), "fingerprint").alias("dedup_key"), "campaign_id", "assigned_split", "evaluation_tier", F.col("_v").alias("task_view"), e.alias("events"),
        F.struct(generation.alias("candidate_generation"), ids(e, INPUT).alias("input_event_ids"), ids(e, TARGET).alias("target_event_ids"), ids(e, HIDDEN).alias("withheld_event_ids"), visible.alias("result_label_visible")).alias("view"),
        F.struct("disposition", "candidate_commit", "restoration_commit").alias("outcome"), *[c for c in CARRIED if c in candidates.columns],
    )


def rendered(events: Column, wanted: Column) -> Column:
    """Events of an id list as text, each under its type and evidence."""
    text = lambda e: F.concat(F.lit("["), e["event_type"], F.lit(" | evidence: "), F.when(F.size(e["evidence_refs"]) > 0, F.array_join(e["evidence_refs"], ", ")).otherwise("none"), F.lit("]\n"), e["payload"])
    return F.array_join(ordered_lookup(wanted, events, lambda e: e["event_id"], text), "\n\n")


def sft(episodes_: DataFrame) -> DataFrame:
    """id, split, messages (system, user, assistant) of episodes outside quarantine."""
    say = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return episodes_.where("assigned_split != 'quarantine'").select(F.col("episode_id").alias("id"), F.col("assigned_split").alias("split"), F.array(say("system", F.lit("Use only the given evidence.")), say("user", rendered(F.col("events"), F.col("view.input_event_ids"))), say("assistant", rendered(F.col("events"), F.col("view.target_event_ids")))).alias("messages"), "family_id", "task_view")


def _carried(episodes_: DataFrame, column: str, alias: str) -> Column:
    """A carried column, or nulls where the episodes don't have it."""
    return (F.col(column) if column in episodes_.columns else F.lit(None).cast("array<string>")).alias(alias)


def evaluated(episodes_: DataFrame) -> DataFrame:
    """Prompts and labels of validation and test episodes, each episode's in one row: it is built once."""
    e = episodes_.where(F.col("assigned_split").isin("validation", "test"))
    rubric = F.array(*[F.lit(r) for r in RUBRIC]).alias("rubric")
    prompt, answer = (rendered(F.col("events"), F.col(f"view.{role}_event_ids")) for role in ("input", "target"))
    return e.select(F.col("episode_id").alias("id"), "assigned_split", prompt.alias("prompt"), "task_view", _carried(e, "architectures", "architecture_scope"), rubric, answer.alias("reference_answer"), "outcome", _carried(e, "snapshot_refs", "required_snapshot_refs"))


#: What may be published of an evaluation, and what may not.
PUBLIC, PRIVATE = ["id", "assigned_split", "prompt", "task_view", "architecture_scope", "rubric"], ["id", "reference_answer", "outcome", "required_snapshot_refs"]


def evaluation(episodes_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Public prompts and private labels of validation and test episodes."""
    e = evaluated(episodes_)
    return e.select(*PUBLIC), e.select(*PRIVATE)


def preferences(episodes_: DataFrame) -> DataFrame:
    """Training episodes with a preference: prompt, the chosen events as text, the rejected answer and why it fails."""
    e = episodes_.where((F.col("assigned_split") == "train") & F.col("preference").isNotNull())
    return e.select(
        F.col("episode_id").alias("id"), rendered(F.col("events"), F.col("view.input_event_ids")).alias("prompt"), rendered(F.col("events"), F.col("preference.chosen_event_ids")).alias("chosen"),
        F.col("preference.rejected_response").alias("rejected"), F.col("preference.failure_mode").alias("failure_mode"), "family_id", _carried(e, "snapshot_refs", "snapshot_refs"),
    )


def quarantined(episodes_: DataFrame) -> DataFrame:
    """Episodes in quarantine with the reasons."""
    e = episodes_.where("assigned_split = 'quarantine'")
    status = F.col("review_status") if "review_status" in e.columns else F.lit(None).cast("string")
    return e.select(F.col("episode_id").alias("id"), "evaluation_tier", "outcome", _carried(e, "limitations", "reason"), status.alias("review_status"), _carried(e, "source_ids", "source_ids"))


def curated_manifest(episodes_: DataFrame) -> DataFrame:
    """relative_path, n of every export that has rows, in one pass over the episodes."""
    split = F.col("assigned_split")
    liked = F.col("preference").isNotNull() if "preference" in episodes_.columns else F.lit(False)
    tested = split.isin("validation", "test")
    paths = F.array(
        F.when(split != "quarantine", F.concat(F.lit("sft/"), split)), F.when((split == "train") & liked, "preference/train"), F.when(tested, F.concat(F.lit("eval/"), split, F.lit(".public"))),
        F.when(tested, F.concat(F.lit("eval/"), split, F.lit(".private"))), F.when(split == "quarantine", "quarantine/index"),
    )
    return episodes_.select(F.explode(F.array_compact(paths)).alias("relative_path")).groupBy("relative_path").agg(F.count("*").alias("n"))
