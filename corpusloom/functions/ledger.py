"""Column expressions for ledger fields: cleaning, aliases, slugs, verdicts and formatted results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that stand for "no value" in ledgers, in lower case.
NO_VALUE = ["", "n/a", "na", "none", "null", "not-applicable", "not applicable", "not-available", "unknown"]
# Spellings of chip targets that a fingerprint doesn't tell apart.
CHIP = r"\b(?:sm|cc)[_-]?(?:86|89|120a?)\b"


def stripped(c: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """The stripped value; empty if it is null or says that there is none."""
    s = F.coalesce(stripped(c.cast("string")), F.lit(""))
    return F.when(F.lower(s).isin(NO_VALUE), "").otherwise(s)


def first_of(columns: list[str], *names: str) -> Column:
    """The first alias, of those among the columns, with a value; else empty."""
    found = [F.nullif(clean(F.col(n)), F.lit("")) for n in names if n in columns]
    return F.coalesce(*found, F.lit(""))


def slug(c: Column, fallback: str = "item") -> Column:
    """Lower case with runs of other characters than a-z and 0-9 as one hyphen, none at the ends."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", fallback).otherwise(s)


def evidence_ref(source: Column, fragment: Column) -> Column:
    return F.concat(source, F.lit("#"), slug(fragment))


def disposition(c: Column) -> Column:
    """accepted, rejected or inconclusive, by the start of the cleaned value."""
    v = F.lower(clean(c))
    return F.when(v.startswith("accept"), "accepted").when(v.startswith("reject"), "rejected").otherwise("inconclusive")


def correctness(c: Column) -> Column:
    """failed before passed: a value may name both."""
    v = F.lower(clean(c))
    fails = v.startswith("fail") | v.contains("oracle fail")
    passes = v.startswith("pass") | v.contains(" pass")
    return F.when(fails, "failed").when(passes, "passed").when(v.rlike("not[ -]run"), "not_run").otherwise("not_observed")


def without_verdict(c: Column) -> Column:
    """The cleaned value without a leading verdict and colon."""
    return F.regexp_replace(clean(c), r"(?i)^(?:accept|accepted|reject|rejected)\s*:\s*", "")


def program_result(direct: Column, boundary: Column, baseline: Column, reps: list[tuple[Column, Column]]) -> Column:
    """A direct result if there is one, else what was measured, as phrases joined by semicolons."""
    given = lambda c: F.nullif(clean(c), F.lit(""))
    phrases = [given(boundary), F.concat(F.lit("baseline "), given(baseline), F.lit(" ms"))]
    for k, (ms, delta) in enumerate(reps, 1):
        gain = F.coalesce(F.concat(F.lit(" ("), given(delta), F.lit("% improvement)")), F.lit(""))
        phrases.append(F.concat(F.lit(f"rep{k} "), given(ms), F.lit(" ms"), gain))
    return F.when(clean(direct) != "", without_verdict(direct)).otherwise(F.concat_ws("; ", *phrases))


def family(text: Column, default: Column, rules: list[tuple[str, list[str], list[str]]], fixed: str = "cross_kernel_consolidation") -> Column:
    """The name of the first rule (name, all of these, any of those) that the text meets."""
    low = F.lower(text)
    out = F.when(default == fixed, default)
    for name, every, some in rules:
        test = F.lit(True)
        for w in every:
            test = test & low.contains(w)
        if some:
            test = test & F.array_contains(F.array(*[low.contains(w) for w in some]), F.lit(True))
        out = out.when(test, name)
    return out.otherwise(default)


# Operator families in order of precedence, with words that must all and words of which one must occur.
FAMILIES = [
    ("dflash2_accept", ["dflash2"], ["accept", "select", "sampling"]),
    ("gqa_attention", [], ["gqa", "attention", "softmax", "key split"]),
    ("gated_delta_net", [], ["recurrent", "replay", "gated delta", "gdn"]),
    ("linear_swiglu", ["swiglu"], []),
    ("nvfp4_linear", ["nvfp4"], []),
    ("fp8_linear", ["fp8"], []),
    ("q4_linear", ["q4"], []),
    ("w8_linear", [], ["w8", "q8"]),
    ("grouped_dynamic_convolution", ["convolution"], []),
]


def place(cycle_candidate: Column, cycle: Column, candidate: Column, order: Column, source: Column, index: Column) -> Column:
    """struct<cycle, candidate, order> of a ledger row, from whichever fields it has.

    "5.3" names cycle and candidate; a cycle may else stand in the source's name or lead the order; the row's number is the
    last resort for a candidate.
    """
    cc, cy, ca, od = (clean(x) for x in (cycle_candidate, cycle, candidate, order))
    parts = F.split(cc, r"\.", 2)
    none = F.lit("")
    candidate_1 = F.when(ca != none, ca).when(cc == none, none).when(F.size(parts) == 2, parts[1]).otherwise(cc)
    cycle_1 = F.when(cy != none, cy).when(cc != none, parts[0]).otherwise(none)
    numbered = lambda c, k: F.concat(F.lit("c"), c, F.lit("_"), F.format_string("%02d", k.try_cast("long")))
    order_1 = F.when(od != none, od).when(cc == none, none).when(candidate_1.rlike("^[0-9]+$"), numbered(cycle_1, candidate_1)).otherwise(cc)
    in_source = F.regexp_extract(source, r"(?:^|-)cycle([0-9]+)(?:-|$)", 1)
    in_order = F.regexp_extract(F.when(order_1 != none, order_1).otherwise(candidate_1), r"^cc?([0-9]+)_", 1)
    cycle_2 = F.coalesce(F.nullif(cycle_1, none), F.nullif(in_source, none), F.nullif(in_order, none), F.lit("unknown"))
    candidate_2 = F.when(candidate_1 != none, candidate_1).otherwise(index.cast("string"))
    order_2 = F.when(order_1 != none, order_1).when(candidate_2.rlike("^[0-9]+$"), numbered(cycle_2, candidate_2)).otherwise(candidate_2)
    return F.struct(cycle_2.alias("cycle"), candidate_2.alias("candidate"), order_2.alias("order"))


def decision_sentence(verdict: Column, reason: Column, restored: Column) -> Column:
    """What a decision event says."""
    # Verbs and sentences of decisions.
    verb = F.element_at(F.create_map(*[F.lit(x) for x in ("accepted", "Accept", "rejected", "Reject", "inconclusive", "Mark inconclusive")]), verdict)
    after = (
        F.when((verdict == "rejected") & restored.isNotNull(), " Restore the candidate through the recorded normal revert and preserve the evidence.")
        .when(verdict == "accepted", " Retain the source only after the declared correctness, control, and real-boundary gates pass.")
        .otherwise("")
    )
    return F.replace(F.concat(verb, F.lit(". "), reason, F.lit("."), after), F.lit(".."), F.lit("."))


# File name endings by MIME type.
ENDINGS = {"text/html": ".html", "application/pdf": ".pdf", "application/json": ".json", "text/plain": ".txt", "text/csv": ".csv", "text/markdown": ".md"}


def ending(mime: Column, url: Column) -> Column:
    """The file name ending of a MIME type, else that of the URL's path, else .bin."""
    out = F.when(F.lit(False), "")
    for k, v in ENDINGS.items():
        out = out.when(mime == k, v)
    own = F.regexp_extract(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), r"(\.[A-Za-z0-9]+)$", 1)
    return out.otherwise(F.when(own == "", ".bin").otherwise(F.lower(own)))


def mime(path: Column) -> Column:
    """MIME type by file name ending."""
    out = F.when(F.lit(False), "")
    for k, v in (ENDINGS | {"application/x-ndjson": ".jsonl"}).items():
        out = out.when(F.lower(path).endswith(v), k)
    return out.otherwise("application/octet-stream")


# Patterns of secrets, at build time and (with the last) at validation. "strict" adds tokens as they are in use.
SECRETS = {
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "token": r"\b(?:ghp|github_pat|sk)-[A-Za-z0-9_-]{20,}\b",
    "aws_key": r"\bAKIA[0-9A-Z]{16}\b",
}
STRICT_SECRETS = SECRETS | {"used_token": r"\b(?:ghp_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,})\b", "assigned": r"(?i)\b(?:token|secret|password|api_key)\s*[:=]\s*\"[^\"]{16,}\""}


def secrets(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """Names of the patterns that occur."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), name) for name, p in (patterns or SECRETS).items()]))
