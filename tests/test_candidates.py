"""The wide projection over small ledgers, worked out by hand."""

import pytest

from corpusloom.operators import builder, candidates

A, B, C = "a" * 40, "b" * 40, "c" * 40
PATCH = "diff --git a/src/x.cu b/src/x.cu\nindex 1\n--- a/src/x.cu\n+++ b/src/x.cu\n@@ -1,2 +1,2 @@\n keep\n-old\n+new\n"


@pytest.fixture(scope="module")
def made(spark):
    rows = [
        ("k1", "camp", "run-cycle2-ledger", 1, "3", None, "Fused softmax", "fewer passes", "9.5", "accept: 41 ms", "Accepted", "pass", A[:9], "", "src/x.cu"),
        ("k2", "camp", "run-cycle2-ledger", 2, "4", None, "", "", "n/a", "", "reject", "fail", B, C[:8], ""),
        ("k3", "camp", "run-cycle2-ledger", 3, None, "5.7", "plain", None, None, None, "open", None, B, A, None),
        ("k4", "other", "loose", 4, None, None, None, None, None, None, None, None, "dddddddd", None, None),
    ]
    ledger_ = spark.createDataFrame(rows, "key string, campaign_id string, source_id string, line int, candidate string, cycle_candidate string, changed_mechanism string, package_hypothesis string, public_op_baseline string, result string, decision string, oracle string, commit string, restoration string, files string")
    campaigns = spark.createDataFrame([("camp", "train", "train", ["ctx"], "base_family"), ("other", "test", "in_arch", None, "other")], "campaign_id string, assigned_split string, evaluation_tier string, context_source_ids array<string>, default_op_family string")
    cycles = spark.createDataFrame([("camp", "5", "validation", "in_arch")], "campaign_id string, cycle string, assigned_split string, evaluation_tier string")
    history = spark.createDataFrame([(A, PATCH, None, "hist"), (B, "", None, "hist"), (C, "", B, "hist2")], "commit string, patch string, reverts_commit string, source_id string")
    fixes = [("camp", "fix2", 2, 1, "c2_03", "", "40.0 ms", "n/a", "late", None), ("camp", "fix1", 1, 1, "3", "2", "39 ms", "rejected", "early", "it failed"), ("other", "fix1", 1, 2, "3", "", "1 ms", "", "", "")]
    corrections = spark.createDataFrame(fixes, "campaign_id string, source_id string, source_pos int, line int, about string, in_cycle string, corrected_public_candidate string, corrected_decision string, impact string, issue string")
    names = ["run-cycle2-ledger", "ctx", "hist", "hist2", "fix1", "fix2", "loose"]
    latest = spark.createDataFrame([(n, f"raw:{n}", f"2024-01-0{i + 1}T00:00:00Z") for i, n in enumerate(names)], "source_id string, record_id string, created_at string")
    registry = spark.createDataFrame([("ctx", "2025-06-01")], "source_id string, source_date string")
    return {r.key: r for r in candidates.candidates(ledger_, campaigns, cycles, history, corrections, latest, registry).collect()}


def test_a_corrected_candidate(made):
    k = made["k1"]
    assert (k.cycle, k.candidate, k.order) == ("2", "3", "c2_03")
    assert (k.mechanism, k.hypothesis, k.files, k.public_baseline) == ("Fused softmax", "fewer passes", "src/x.cu", "9.5")
    assert (k.public_candidate, k.disposition, k.reason) == ("40.0 ms", "rejected", "early late")  # the last correction that says something counts
    assert k.candidate_commit is None and k.limitations == [builder.LIMITATIONS["edge"]]  # rejected, and no restoration is proven
    assert k.raw_candidate_commit == A[:9] and "src/x.cu" in k.patch and k.preimage == "### src/x.cu\n@@ -1,2 +1,2 @@\n keep\n-old"
    assert k.op_family == "gqa_attention" and len(k.fingerprint) == 64 and k.correctness == "passed"
    assert k.source_ids == ["run-cycle2-ledger", "ctx", "fix1", "fix2", "hist"] and k.snapshot_refs == [f"raw:{s}" for s in k.source_ids]
    assert k.evidence_cutoff == "2025-06-01" and k.ledger_ref == "run-cycle2-ledger#c2-03" and k.history_ref == f"hist#{A}"
    assert k.correction_refs == ["fix1#c2-03", "fix2#c2-03"] and k.correction_text.startswith("Correction from fix1. issue: it failed")
    assert k.performance_claim == f"public Op: 40.0 ms; correction: {k.correction_text}"
    assert (k.assigned_split, k.evaluation_tier) == ("train", "train")


def test_a_proven_revert(made):
    k = made["k2"]
    assert (k.disposition, k.candidate_commit, k.restoration_commit, k.limitations) == ("rejected", B, C, [])
    assert k.mechanism == "c2_04" and k.reason == "reject" and k.op_family == "base_family" and k.public_baseline == ""
    assert k.source_ids == ["run-cycle2-ledger", "ctx", "hist", "hist2"] and k.restoration_ref == f"hist2#{C}"
    assert k.performance_claim == "No performance measurement was observed." and k.patch == "" and k.preimage == ""


def test_an_open_row_in_a_cycle_of_its_own(made):
    k = made["k3"]
    assert (k.cycle, k.candidate, k.order) == ("5", "7", "c5_07") and (k.assigned_split, k.evaluation_tier) == ("validation", "in_arch")
    assert (k.disposition, k.candidate_commit, k.restoration_commit) == ("inconclusive", B, A) and k.correctness == "not_observed"


def test_a_row_of_nulls(made):
    k = made["k4"]
    assert (k.cycle, k.candidate, k.order) == ("unknown", "4", "cunknown_04") and k.limitations == [builder.LIMITATIONS["commit"]]
    assert k.source_ids == ["loose"] and k.disposition == "inconclusive" and k.history_ref == k.ledger_ref == "loose#cunknown-04" and k.correction_refs == []
