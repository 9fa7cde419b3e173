"""Candidates straight from ledger rows: the wide projection over corrections, histories, campaigns and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import ledger, patches
from corpusloom.operators import builder, joins
from corpusloom.sources import tables

# Names that ledgers give to a field, in order of precedence.
ALIASES = {
    "mechanism": ["mechanism", "changed_mechanism", "package_hypothesis", "scope"], "hypothesis": ["hypothesis", "package_hypothesis"], "prediction": ["predicted_effect"], "rejection": ["rejection_observation"],
    "dispatch": ["dispatch_domain", "dispatch_domains", "scope"], "files": ["files"], "public_baseline": ["public_op_baseline", "combined_public_baseline"], "program_baseline": ["program_baseline_ms"],
    "public_candidate": ["public_op_candidate", "combined_public_candidate", "public_op_result", "public_or_profile", "result"], "oracle_result": ["oracle_result", "oracle"], "compile_result": ["compile_result"],
    "seams": ["unaffected_seams"], "sentinels": ["engine_sentinels"], "raw_decision": ["decision"], "raw_candidate_commit": ["candidate_commit", "commit"], "raw_restoration_commit": ["restoration_commit", "restoration"],
    "row_reason": ["reason"], "components": ["component_mechanisms"],
}
# What a correction replaces, and its fields that may be a reason.
REPLACED = {"public_baseline": "corrected_public_baseline", "public_candidate": "corrected_public_candidate", "raw_decision": "corrected_decision"}
REASONS = ["corrected_projection", "corrected_claim", "impact", "decision_effect"]
CORRECTION = ["source_id", "source_pos", "line"]


def _fields(rows: DataFrame) -> dict[str, Column]:
    """Fields by whichever names the header has."""
    out = {name: ledger.first_of(rows.columns, *names) for name, names in ALIASES.items()}
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    reps = [(own(f"program_rep{k}_ms"), own(f"program_rep{k}_delta_pct")) for k in (1, 2)]
    out["program_result"] = ledger.program_result(own("real_boundary_result"), own("program_boundary"), own("program_baseline_ms"), reps)
    out["public_candidate"] = ledger.without_verdict(out["public_candidate"])
    return out


def _corrected(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """key, the replaced fields, reason, text, sources and references of each row that corrections of its campaign name."""
    slots = rows.select(F.col("key").alias("pos_key"), F.col("campaign_id").alias("_campaign"), F.col("order").alias("_order"), "cycle", "candidate", "order")
    lacking = [c for c in (*REPLACED.values(), *REASONS) if c not in corrections.columns]
    known = corrections.withColumns({c: F.lit(None).cast("string") for c in lacking}) if lacking else corrections
    at = F.struct("source_pos", "line")
    matched = joins.corrections_for(slots, known.withColumn("at", at), ["_campaign", "_order"]).where(F.col("campaign_id") == F.col("_campaign"))
    refs = F.array_sort(F.collect_list(F.struct("at", F.col("source_id").alias("s"), ledger.evidence_ref(F.col("source_id"), F.col("_order")).alias("r"))))
    said = [*joins.overlaid(list(REPLACED.values()), "at"), joins.all_reasons(REASONS, "at"), builder.all_corrections(matched.columns), refs.alias("refs")]
    found = matched.groupBy(F.col("pos_key").alias("_key")).agg(*said)
    return found.withColumns({"sources": F.transform("refs", lambda x: x["s"]), "correction_refs": F.transform("refs", lambda x: x["r"])}).drop("refs")


def candidates(rows: DataFrame, campaigns: DataFrame, cycles: DataFrame, history: DataFrame, corrections: DataFrame, latest: DataFrame, registry: DataFrame, max_patch: int = builder.MAX_PATCH, max_preimage: int = builder.MAX_PREIMAGE) -> DataFrame:
    """A row for each ledger row, with the fields that views, splits and exports are made of.

    rows: key (unique), campaign_id, source_id, line (from 1 in its file) and the ledger's own columns, all text, under any of their names.
    campaigns: campaign_id, assigned_split, evaluation_tier, context_source_ids, default_op_family. cycles: campaign_id, cycle and a split and tier of
    its own. history: one row per commit (commit, patch, reverts_commit, source_id). corrections: campaign_id, source_id, source_pos, line,
    about, in_cycle and what they correct. latest and registry: records and dates of sources. Raises on unknown splits and tiers, ambiguous commits and sources without a record.
    Null and empty cells are no values; an empty ledger gives no rows.
    """
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    # the wide rows are written twice and shuffled once, by their key; whatever else is asked of them is found by few of their columns
    folder = tables.scratch(rows.sparkSession, "candidates")
    # written, as Spark then knows what is small enough to be sent to the rows
    campaigns, cycles, corrections, latest, registry = (tables.saved(x, f"{folder}/{n}") for n, x in (("campaigns", campaigns), ("cycles", cycles), ("corrections", corrections), ("latest", latest), ("registry", registry)))
    there = F.struct(*[F.col(c) for c in ("key", "campaign_id", "source_id", "line")])
    place = ledger.place(own("cycle_candidate"), own("cycle"), own("candidate"), own("order"), F.col("source_id"), F.col("line"))
    d = rows.select(there.alias("_at"), place.alias("_place"), *[c.alias(n) for n, c in _fields(rows).items()]).select("_at.*", "_place.*", *_fields(rows))
    d = builder.assigned(d, campaigns, cycles).join(campaigns.select(F.col("campaign_id").alias("_c"), "context_source_ids", "default_op_family"), F.col("campaign_id") == F.col("_c")).drop("_c")
    d = tables.saved(d, f"{folder}/fields")
    fixed = tables.saved(_corrected(d, corrections), f"{folder}/corrected")
    told = joins.told_by_history(d, history, "key", {"raw_candidate_commit": ["patch", "source_id"], "raw_restoration_commit": ["source_id", "reverts_commit"]})
    told = told.select(F.col("key").alias("_told"), F.col("raw_candidate_commit").alias("_candidate"), F.col("raw_restoration_commit").alias("_restoration"))
    d = d.join(told, F.col("key") == F.col("_told"), "left").join(fixed, F.col("key") == F.col("_key"), "left").drop("_told", "_key")
    new = lambda c: F.coalesce(F.nullif(ledger.clean(F.col(REPLACED[c])), F.lit("")), F.col(c))
    d = d.withColumns({c: new(c) for c in REPLACED}).withColumnRenamed("reason", "_why").drop(*REPLACED.values())
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    d = d.withColumns({
        "disposition": ledger.disposition(F.col("raw_decision")), "correctness": ledger.correctness(F.col("oracle_result")), "correction_text": F.coalesce("correction_text", F.lit("")),
        "reason": F.coalesce(given("_why"), given("row_reason"), given("public_candidate"), given("program_result"), F.col("raw_decision")), "correction_refs": F.coalesce("correction_refs", F.array().cast("array<string>")),
    })
    d = d.withColumns({
        "candidate_commit": joins.told_commit("_candidate", "raw_candidate_commit"), "restoration_commit": joins.told_commit("_restoration", "raw_restoration_commit"), "raw_patch": F.col("_candidate.patch"),
        "history_source": F.col("_candidate.source_id"), "restoration_source": F.col("_restoration.source_id"), "restores": F.col("_restoration.reverts_commit"),
    }).drop("_candidate", "_restoration")
    d = joins.proven_by(d, "restores").drop("restores")
    d = d.withColumn("limitations", F.array_compact(F.array(F.when(F.col("unproven"), builder.LIMITATIONS["edge"]), F.when((F.col("raw_candidate_commit") != "") & F.col("candidate_commit").isNull(), builder.LIMITATIONS["commit"]))))
    some = F.concat(F.array("source_id"), F.coalesce("context_source_ids", F.array().cast("array<string>")), F.coalesce("sources", F.array().cast("array<string>")), F.array_compact(F.array("history_source", "restoration_source")))
    d = tables.saved(d.withColumn("_some", some).drop("sources", "context_source_ids"), f"{folder}/linked")
    # many rows have the same sources: evidence is found once for each list of them
    found = builder.evidence(d.select(F.col("_some").alias("pos_key"), F.col("_some").alias("source_ids")).distinct(), latest, registry).withColumnRenamed("pos_key", "_list")
    found = tables.saved(found, f"{folder}/evidence")
    d = d.withColumn("patch", patches.code_only(F.coalesce("raw_patch", F.lit("")))).withColumn("preimage", patches.preimage(F.col("patch")))
    d = builder.limited(d, max_patch, max_preimage)
    d = d.withColumn("op_family", ledger.family(F.concat_ws(" ", "mechanism", "hypothesis", "dispatch", "files", "components"), F.col("default_op_family"), ledger.FAMILIES))
    d = d.withColumn("fingerprint", patches.fingerprint(F.col("patch"), F.col("mechanism"), F.col("files"), F.col("op_family")))
    d = d.join(found, F.col("_some") == F.col("_list")).drop("_some", "_list")
    ref = ledger.evidence_ref(F.col("source_id"), F.col("order"))
    by = lambda source, commit: F.when(F.col(source).isNotNull() & F.col(commit).isNotNull(), ledger.evidence_ref(F.col(source), F.col(commit))).otherwise(ref)
    told = lambda label, c: F.concat(F.lit(f"{label}: "), given(c))
    claim = F.concat_ws("; ", told("public Op", "public_candidate"), told("real boundary", "program_result"), told("correction", "correction_text"))
    return d.select(
        "key", "campaign_id", "source_id", "cycle", "candidate", "order", F.coalesce(given("mechanism"), given("dispatch"), "order").alias("mechanism"), "hypothesis", "prediction", "rejection", "dispatch", "files", "public_baseline", "public_candidate",
        "program_baseline", "program_result", "compile_result", "oracle_result", "seams", "sentinels", "disposition", "reason", "correctness", F.col("linked_commit").alias("candidate_commit"), F.col("linked_restoration").alias("restoration_commit"),
        "raw_candidate_commit", "raw_restoration_commit", "patch", "preimage", "op_family", "fingerprint", "source_ids", "snapshot_refs", "evidence_cutoff", ref.alias("ledger_ref"), by("history_source", "candidate_commit").alias("history_ref"),
        by("restoration_source", "restoration_commit").alias("restoration_ref"), "correction_text", "correction_refs", F.when(claim != "", claim).otherwise("No performance measurement was observed.").alias("performance_claim"), "limitations", "assigned_split", "evaluation_tier",
    )
