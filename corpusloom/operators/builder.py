"""From ledger rows to candidates: splits by campaign and cycle, context, evidence, corrections, limits and omissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import ledger
from corpusloom.operators.joins import spread
from corpusloom.operators.groups import SPLITS

# Evaluation tiers.
TIERS = ["train", "in_arch", "cross_arch", "real_hardware", "quarantine"]
# Fields of a correction that its text names, in this order.
CORRECTION_FIELDS = ["issue", "original_claim", "corrected_claim", "corrected_public_baseline", "corrected_public_candidate", "corrected_projection", "corrected_decision", "decision_effect", "impact"]
# Most characters of a patch and of its pre-image.
MAX_PATCH, MAX_PREIMAGE = 64_000, 64_000
LIMITATIONS = {
    "patch": "The patch is longer than the limit of an implementation target; there is no implementation view.",
    "preimage": "The source before the change is longer than its limit; there is no implementation view.",
    "edge": "The history does not prove that the restoration reverts the candidate; the row serves judgment only.",
    "commit": "The candidate's commit was not found in the declared history.",
}
# The lists of sources of a campaign.
SOURCE_LISTS = ["ledger_source_ids", "history_source_ids", "context_source_ids", "correction_source_ids"]


def _one_of(value: Column, allowed: list[str], what: str) -> Column:
    named = F.concat(F.lit(f"invalid {what} of "), F.col("campaign_id"), F.lit(" cycle "), F.coalesce(F.col("cycle"), F.lit("")), F.lit(": "), F.coalesce(value, F.lit("none")))
    return F.when(value.isin(allowed), value).otherwise(F.raise_error(named).cast("string"))


def assigned(rows: DataFrame, campaigns: DataFrame, cycles: DataFrame) -> DataFrame:
    """rows (campaign_id, cycle) with assigned_split and evaluation_tier: those of the cycle where it has its own, else the campaign's.

    No split comes from chance or from row numbers. Raises on a value outside the known splits and tiers.
    """
    c = campaigns.select("campaign_id", F.col("assigned_split").alias("_split"), F.col("evaluation_tier").alias("_tier"))
    o = cycles.select("campaign_id", "cycle", F.col("assigned_split").alias("_own_split"), F.col("evaluation_tier").alias("_own_tier"))
    d = rows.join(c, "campaign_id").join(o, ["campaign_id", "cycle"], "left")
    split, tier = F.coalesce("_own_split", "_split"), F.coalesce("_own_tier", "_tier")
    return d.withColumns({"assigned_split": _one_of(split, SPLITS, "split"), "evaluation_tier": _one_of(tier, TIERS, "tier")}).drop("_split", "_tier", "_own_split", "_own_tier")


def scope(repository: str = "repository") -> Column:
    """The scope of a candidate with its campaign's columns."""
    return F.struct(
        F.lit(repository).alias("repository"), F.col("target"), F.col("boundary"), F.col("op_family"), F.array("architecture").alias("architectures"), F.array("hardware_sku").alias("hardware_skus"), F.col("workload")
    )


def context() -> Column:
    """What a view says about the place of a candidate; workload is JSON text as it is to be shown."""
    said = lambda label, c: F.concat(F.lit(f"{label}: "), c, F.lit("."))
    given = lambda c: F.nullif(ledger.clean(F.col(c)), F.lit(""))
    hardware = F.concat(F.col("hardware_sku"), F.lit(" ("), F.col("architecture"), F.lit(")"))
    return F.concat_ws(" ", said("Target", F.col("target")), said("Hardware", hardware), said("Boundary", F.col("boundary")), said("Workload", F.col("workload")), said("Dispatch scope", given("dispatch")), said("Affected files", given("files")))


def correction_text(matched: DataFrame, key: str = "pos_key", source: str = "source_id", order: tuple = ("source_pos", "line")) -> DataFrame:
    """key, correction_text: a line for each correction of a candidate, in order, of its source and its labelled fields that have a value."""
    return matched.groupBy(key).agg(all_corrections(matched.columns, source, order))


def all_corrections(columns: list[str], source: str = "source_id", order: tuple = ("source_pos", "line")) -> Column:
    """correction_text of a group of corrections with these columns."""
    there = [c for c in CORRECTION_FIELDS if c in columns]
    parts = [F.concat(F.lit(c.replace("_", " ") + ": "), F.nullif(ledger.clean(F.col(c)), F.lit(""))) for c in there]
    line = F.concat_ws(" ", F.concat(F.lit("Correction from "), F.col(source), F.lit(".")), *parts)
    lines = F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], line.alias("_text"))))
    return F.array_join(F.transform(lines, lambda x: x["_text"]), "\n").alias("correction_text")


def with_history(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """candidates with raw_patch, history_source, restoration_source and restores: what the history says of both commits, null where
    it doesn't have them. History has one row per commit."""
    h = history.select(F.col("commit").alias("_c"), F.col("patch").alias("raw_patch"), F.col("source_id").alias("history_source"))
    r = history.select(F.col("commit").alias("_r"), F.col("source_id").alias("restoration_source"), F.col("reverts_commit").alias("restores"))
    found = candidates.join(h, spread(F.col("candidate_commit"), candidates) == F.col("_c"), "left").join(r, spread(F.col("restoration_commit"), candidates) == F.col("_r"), "left")
    return found.drop("_c", "_r")


def limited(candidates: DataFrame, max_patch: int = MAX_PATCH, max_preimage: int = MAX_PREIMAGE) -> DataFrame:
    """patch and preimage empty where either is longer than its limit, with the limitation that says so."""
    long_patch = F.coalesce(F.length("patch") > max_patch, F.lit(False))
    long_image = ~long_patch & F.coalesce(F.length("preimage") > max_preimage, F.lit(False))
    said = F.array_compact(F.array(F.when(long_patch, LIMITATIONS["patch"]), F.when(long_image, LIMITATIONS["preimage"])))
    empty = lambda c: F.when(long_patch | long_image, "").otherwise(F.col(c))
    return candidates.withColumns({"patch": empty("patch"), "preimage": empty("preimage"), "limitations": F.concat(F.coalesce("limitations", F.array().cast("array<string>")), said)})


def without_seed(candidates: DataFrame, seed: DataFrame, commit: str = "candidate_commit") -> DataFrame:
    """Candidates whose commit no seed episode has; one without a commit stays."""
    known = seed.select(F.col(commit).alias("_seed")).where("_seed is not null").distinct()
    return candidates.join(known, F.col(commit) == F.col("_seed"), "left_anti")


def omissions(rows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """reason, n of rows left out, all reasons in one pass; a reason without rows isn't listed."""
    counted = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(r) for r, c in reasons.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in reasons]))).where("n > 0")


def campaign_sources(campaigns: DataFrame) -> DataFrame:
    """campaign_id, role, place, source_id of every source that a campaign names."""
    lists = F.array(*[F.struct(F.lit(c.removesuffix("_source_ids")).alias("role"), F.col(c).alias("ids")) for c in SOURCE_LISTS])
    return campaigns.select("campaign_id", F.inline(lists)).select("campaign_id", "role", F.posexplode("ids").alias("place", "source_id"))


def refused(sources: DataFrame, registry: DataFrame, records: DataFrame) -> DataFrame:
    """source_id, reason of sources that must not be read: not registered, live, not collected, without a raw record, or a ledger
    that isn't CSV. Sources: role, source_id; registry: source_id, source_class, ingestion_status; records: source_id, relative_path."""
    r = registry.select(F.col("source_id").alias("_s"), "source_class", "ingestion_status")
    p = records.select(F.col("source_id").alias("_p"), "relative_path")
    d = sources.select("role", "source_id").distinct().join(r, F.col("source_id") == F.col("_s"), "left").join(p, F.col("source_id") == F.col("_p"), "left")
    reason = (
        F.when(F.col("_s").isNull(), "not registered").when(F.col("source_class").endswith("live_reference"), "live").when(~F.col("ingestion_status").eqNullSafe(F.lit("collected")), "not collected")
        .when(F.col("_p").isNull(), "no raw record").when((F.col("role") == "ledger") & ~F.lower("relative_path").endswith(".csv"), "not a CSV ledger")
    )
    return d.select("role", "source_id", reason.alias("reason")).where("reason is not null")


def admitted(sources: DataFrame, registry: DataFrame, records: DataFrame) -> DataFrame:
    """The sources; raises, with up to four of them, where any is refused."""
    bad = refused(sources, registry, records).select(F.concat_ws(" ", "source_id", "reason").alias("b")).orderBy("b").limit(4).agg(F.array_join(F.array_sort(F.collect_list("b")), "; ").alias("b"))
    told = F.when(F.col("b") == "", F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("refused sources: "), "b")).cast("boolean"))
    # one row, whatever the number of sources
    return sources.join(F.broadcast(bad.select(told.alias("_fine"))), F.col("_fine")).drop("_fine")


def evidence(candidates: DataFrame, latest: DataFrame, registry: DataFrame, key: str = "pos_key") -> DataFrame:
    """key, source_ids (first occurrences), snapshot_refs in their order, and evidence_cutoff: the latest time among the sources, as
    written. A source's time is its registered date, else its record's. Raises where a source has no record."""
    each = candidates.select(key, F.posexplode(F.array_distinct("source_ids")).alias("p", "source_id"))
    l = latest.select(F.col("source_id").alias("_s"), "record_id", "created_at")
    g = registry.select(F.col("source_id").alias("_g"), "source_date")
    d = each.join(l, F.col("source_id") == F.col("_s"), "left").join(g, F.col("source_id") == F.col("_g"), "left")
    ref = F.coalesce("record_id", F.raise_error(F.concat(F.lit("no raw record of "), "source_id")).cast("string"))
    time = F.coalesce(F.nullif(ledger.clean(F.col("source_date")), F.lit("")), F.col("created_at"))
    rows = d.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("p", "source_id", ref.alias("ref")))).alias("r"), F.max_by(time, F.struct(F.try_to_timestamp(time), time)).alias("evidence_cutoff"))
    return rows.select(key, F.transform("r", lambda x: x["source_id"]).alias("source_ids"), F.transform("r", lambda x: x["ref"]).alias("snapshot_refs"), "evidence_cutoff")


def first_few(df: DataFrame, column: str, most: int = 10) -> DataFrame:
    """message: the number of rows and the first values in order, at most so many, for a report."""
    total = df.agg(F.count("*").alias("n"))
    few = df.select(F.col(column).cast("string").alias("v")).orderBy("v").limit(most).agg(F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("v"))
    return total.join(F.broadcast(few)).select(F.concat(F.col("n").cast("string"), F.lit(": "), "v").alias("message"))
