"""Queries on fields, predicates, joins and aggregates of ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import ledger, patches
from corpusloom.operators import groups, joins
from corpusloom.plans.registry import COMMIT, HISTORY, LEDGER, PATCH, register, relation, table
from corpusloom.sources import tables

NONE = "('', 'n/a', 'na', 'none', 'null', 'not-applicable', 'not applicable', 'not-available', 'unknown')"


def sql_clean(c: str) -> str:
    return f"(CASE WHEN lower(trim(coalesce({c}, ''))) IN {NONE} THEN '' ELSE trim(coalesce({c}, '')) END)"


VERDICT = f"(CASE WHEN lower({sql_clean('decision')}) LIKE 'accept%' THEN 'accepted' WHEN lower({sql_clean('decision')}) LIKE 'reject%' THEN 'rejected' ELSE 'inconclusive' END)"
UNVERDICT = "regexp_replace({0}, '^(accept|accepted|reject|rejected)\\s*:\\s*', '', 'i')"


@register("pr_fields", f"""WITH l AS ({LEDGER}), c AS (SELECT *, {sql_clean('oracle_result')} AS o FROM l)
SELECT pos, {sql_clean('decision')} AS cleaned, {VERDICT} AS disposition,
 CASE WHEN lower(o) LIKE 'fail%' OR lower(o) LIKE '%oracle fail%' THEN 'failed' WHEN lower(o) LIKE 'pass%' OR lower(o) LIKE '% pass%' THEN 'passed' WHEN lower(o) LIKE '%not run%' OR lower(o) LIKE '%not-run%' THEN 'not_run' ELSE 'not_observed' END AS correctness,
 coalesce(nullif({sql_clean('hypothesis')}, ''), nullif({sql_clean('mechanism')}, ''), '') AS hypothesis,
 trim(regexp_replace(lower(campaign_id), '[^a-z0-9]+', '-', 'g'), '-') AS campaign_slug, source_id || '#' || trim(regexp_replace(lower(mechanism), '[^a-z0-9]+', '-', 'g'), '-') AS ref FROM c""")
def fields(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER)
    return d.select("pos", ledger.clean(F.col("decision")).alias("cleaned"), ledger.disposition(F.col("decision")).alias("disposition"), ledger.correctness(F.col("oracle_result")).alias("correctness"), ledger.first_of(d.columns, "hypothesis", "package_hypothesis", "mechanism").alias("hypothesis"), ledger.slug(F.col("campaign_id")).alias("campaign_slug"), ledger.evidence_ref(F.col("source_id"), F.col("mechanism")).alias("ref"))


@register("pr_results", f"""WITH l AS ({LEDGER}) SELECT pos, {UNVERDICT.format(sql_clean('public_op_result'))} AS public_candidate,
 CASE WHEN {sql_clean('real_boundary_result')} <> '' THEN {UNVERDICT.format(sql_clean('real_boundary_result'))} ELSE concat_ws('; ', nullif({sql_clean('program_boundary')}, ''), 'baseline ' || nullif({sql_clean('program_baseline_ms')}, '') || ' ms', 'rep1 ' || nullif({sql_clean('program_rep1_ms')}, '') || ' ms' || coalesce(' (' || nullif({sql_clean('program_rep1_delta_pct')}, '') || '% improvement)', '')) END AS program_result FROM l""")
def results(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER)
    shown = ledger.program_result(F.col("real_boundary_result"), F.col("program_boundary"), F.col("program_baseline_ms"), [(F.col("program_rep1_ms"), F.col("program_rep1_delta_pct"))])
    return d.select("pos", ledger.without_verdict(F.col("public_op_result")).alias("public_candidate"), shown.alias("program_result"))


@register("pr_family", f"""WITH l AS ({LEDGER}), t AS (SELECT pos, lower(mechanism || ' ' || hypothesis) AS t FROM l) SELECT pos, CASE WHEN t LIKE '%dflash2%' AND (t LIKE '%accept%' OR t LIKE '%select%' OR t LIKE '%sampling%') THEN 'dflash2_accept'
 WHEN t LIKE '%gqa%' OR t LIKE '%attention%' OR t LIKE '%softmax%' OR t LIKE '%key split%' THEN 'gqa_attention' WHEN t LIKE '%recurrent%' OR t LIKE '%replay%' OR t LIKE '%gated delta%' OR t LIKE '%gdn%' THEN 'gated_delta_net'
 WHEN t LIKE '%swiglu%' THEN 'linear_swiglu' WHEN t LIKE '%nvfp4%' THEN 'nvfp4_linear' WHEN t LIKE '%fp8%' THEN 'fp8_linear' WHEN t LIKE '%q4%' THEN 'q4_linear' WHEN t LIKE '%w8%' OR t LIKE '%q8%' THEN 'w8_linear' WHEN t LIKE '%convolution%' THEN 'grouped_dynamic_convolution' ELSE 'other' END AS op_family FROM t""")
def op_family(spark, sf_dir):
    return relation(spark, sf_dir, LEDGER).select("pos", ledger.family(F.concat_ws(" ", "mechanism", "hypothesis"), F.lit("other"), ledger.FAMILIES).alias("op_family"))


@register("pr_place", f"""WITH l AS ({LEDGER}), c AS (SELECT pos, source_id, CASE WHEN pos % 3 = 0 THEN cycle || '.' || candidate WHEN pos % 3 = 1 THEN 'x' || candidate END AS cc, CASE WHEN pos % 2 = 0 THEN 'c' || cycle || '_' || candidate END AS o, CASE WHEN pos % 4 = 1 THEN candidate END AS ca FROM l),
 s AS (SELECT *, CASE WHEN cc IS NULL THEN coalesce(ca, '') WHEN ca IS NOT NULL THEN ca WHEN cc LIKE '%.%' THEN split_part(cc, '.', 2) ELSE cc END AS ca1, CASE WHEN cc IS NULL THEN '' ELSE split_part(cc, '.', 1) END AS cy1 FROM c),
 r AS (SELECT *, CASE WHEN o IS NOT NULL THEN o WHEN cc IS NULL THEN '' WHEN regexp_matches(ca1, '^[0-9]+$') THEN 'c' || cy1 || '_' || lpad(ca1, 2, '0') ELSE cc END AS o1 FROM s),
 f AS (SELECT *, CASE WHEN cy1 <> '' THEN cy1 ELSE regexp_extract(source_id, '(?:^|-)cycle([0-9]+)(?:-|$)', 1) END AS cy2, CASE WHEN ca1 <> '' THEN ca1 ELSE CAST(pos AS STRING) END AS ca2 FROM r)
 SELECT pos, coalesce(nullif(cy2, ''), 'unknown') AS cycle, ca2 AS candidate, CASE WHEN o1 <> '' THEN o1 WHEN length(ca2) >= 2 THEN 'c' || cy2 || '_' || ca2 ELSE 'c' || cy2 || '_' || lpad(ca2, 2, '0') END AS ordering FROM f""")
def place(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER)
    cc = F.when(F.col("pos") % 3 == 0, F.concat_ws(".", "cycle", "candidate")).when(F.col("pos") % 3 == 1, F.concat(F.lit("x"), "candidate"))
    order = F.when(F.col("pos") % 2 == 0, F.concat(F.lit("c"), "cycle", F.lit("_"), "candidate"))
    p = ledger.place(cc, F.lit(None).cast("string"), F.when(F.col("pos") % 4 == 1, F.col("candidate")), order, F.col("source_id"), F.col("pos"))
    return d.select("pos", p.alias("p")).select("pos", "p.cycle", "p.candidate", F.col("p.order").alias("ordering"))


@register("pr_decision_sentence", f"""WITH l AS ({LEDGER}), d AS (SELECT pos, {VERDICT} AS v, {sql_clean('public_op_result')} AS r FROM l) SELECT pos, replace(CASE v WHEN 'accepted' THEN 'Accept' WHEN 'rejected' THEN 'Reject' ELSE 'Mark inconclusive' END || '. ' || r || '.' ||
 CASE WHEN v = 'rejected' AND pos % 2 = 0 THEN ' Restore the candidate through the recorded normal revert and preserve the evidence.' WHEN v = 'accepted' THEN ' Retain the source only after the declared correctness, control, and real-boundary gates pass.' ELSE '' END, '..', '.') AS said FROM d""")
def sentence(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER)
    return d.select("pos", ledger.decision_sentence(ledger.disposition(F.col("decision")), ledger.clean(F.col("public_op_result")), F.when(F.col("pos") % 2 == 0, F.lit("x"))).alias("said"))


@register("fl12_secrets", r"""SELECT doc_id, CAST(len(list_filter([CASE WHEN regexp_matches(text, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') THEN 1 END, CASE WHEN regexp_matches(text, '\b(?:ghp|github_pat|sk)-[A-Za-z0-9_-]{20,}\b') THEN 1 END, CASE WHEN regexp_matches(text, '\bAKIA[0-9A-Z]{16}\b') THEN 1 END, CASE WHEN regexp_matches(text, '\b(?:ghp_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,})\b') THEN 1 END, CASE WHEN regexp_matches(text, '(?i)\b(?:token|secret|password|api_key)\s*[:=]\s*"[^"]{16,}"') THEN 1 END], lambda x: x IS NOT NULL)) AS BIGINT) AS n_patterns FROM {documents}""")
def secrets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(ledger.secrets(F.col("text"), ledger.STRICT_SECRETS)).cast("long").alias("n_patterns"))


@register("tx_patches", f"""WITH p AS ({PATCH}), s AS (SELECT pos, mechanism, files, rtrim(substr(patch, strpos(patch, 'diff --git a/src/')), chr(10) || ' ') AS code FROM p),
 l AS (SELECT pos, code, regexp_extract(code, 'b/(src/[^' || chr(10) || ']+)', 1) AS path, string_split(code, chr(10)) AS lines FROM s)
 SELECT pos, code, '### ' || path || chr(10) || array_to_string(list_filter(lines[list_position(list_transform(lines, lambda x: starts_with(x, '@@')), true):], lambda x: starts_with(x, '@@') OR starts_with(x, ' ') OR (starts_with(x, '-') AND NOT starts_with(x, '---'))), chr(10)) AS preimage,
 sha256(array_to_string(list_transform(list_filter(lines, lambda x: NOT starts_with(x, 'index ')), lambda x: rtrim(regexp_replace(regexp_replace(x, '@@ -[^ ]+ \\+[^ ]+ @@', '@@'), '(?i)\\b(?:sm|cc)[_-]?(?:86|89|120a?)\\b', 'sm_x', 'g'))), chr(10))) AS fingerprint FROM l""")
def patch_text(spark, sf_dir):
    d = tables.shared_out(relation(spark, sf_dir, PATCH), "pos").withColumn("code", patches.code_only(F.col("patch")))
    return d.select("pos", "code", patches.preimage(F.col("patch")).alias("preimage"), patches.fingerprint(F.col("code"), F.col("mechanism"), F.col("files"), F.lit("x")).alias("fingerprint"))


@register("tx4_fallback_fingerprint", f"WITH p AS ({PATCH}) SELECT pos, sha256('x|' || lower(mechanism) || '|' || lower(files)) AS fingerprint FROM p")
def fallback(spark, sf_dir):
    return relation(spark, sf_dir, PATCH).select("pos", patches.fingerprint(F.lit(""), F.col("mechanism"), F.col("files"), F.lit("x")).alias("fingerprint"))


@register("jn2_prefix_join", f"""WITH h AS ({HISTORY}), v AS (SELECT l_orderkey AS pos, l_linenumber AS n, CASE WHEN l_linenumber % 3 = 0 THEN upper(substr({COMMIT.format('l_orderkey')}, 1, 12)) WHEN l_linenumber % 3 = 1 THEN {COMMIT.format('l_orderkey')} ELSE 'n/a' END AS value FROM {{lineitem}}),
 c AS (SELECT DISTINCT commit AS c, substr(commit, 1, 12) AS p FROM h) SELECT pos, CAST(n AS BIGINT) AS n, CASE WHEN length(value) = 40 THEN value ELSE c END AS resolved FROM v LEFT JOIN c ON p = lower(value)""")
def prefix_join(spark, sf_dir):
    v = relation(spark, sf_dir, f"SELECT l_orderkey AS pos, CAST(l_linenumber AS BIGINT) AS n, CASE WHEN l_linenumber % 3 = 0 THEN upper(substr({COMMIT.format('l_orderkey')}, 1, 12)) WHEN l_linenumber % 3 = 1 THEN {COMMIT.format('l_orderkey')} ELSE 'n/a' END AS value FROM {{lineitem}}")
    return joins.resolve_prefix(v, relation(spark, sf_dir, HISTORY)).select("pos", "n", "resolved")


CORRECTIONS = """SELECT l_orderkey AS pos, CAST(l_linenumber AS BIGINT) AS line, CASE l_partkey % 4 WHEN 0 THEN CAST(l_orderkey AS STRING) WHEN 1 THEN 'C' || CAST(l_suppkey % 5 AS STRING) || '_' || lpad(CAST(l_orderkey % 24 AS STRING), 2, '0') WHEN 2 THEN 'none' ELSE 'cc1_05' END AS about,
 CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE CAST(l_suppkey % 5 AS STRING) END AS in_cycle, CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'fix ' || CAST(l_partkey AS STRING) END AS corrected_candidate, CASE WHEN l_partkey % 7 = 0 THEN 'rejected' ELSE 'n/a' END AS corrected_decision FROM {lineitem}"""
SLOTS = "SELECT s_suppkey AS pos_key, CAST(s_suppkey % 5 AS STRING) AS cycle, CAST(s_suppkey AS STRING) AS candidate, 'c' || CAST(s_suppkey % 5 AS STRING) || '_' || lpad(CAST(s_suppkey % 24 AS STRING), 2, '0') AS \"order\" FROM {supplier}"
MATCHED = f"""c AS ({SLOTS}), k AS ({CORRECTIONS}), f AS (SELECT DISTINCT pos_key, cycle AS cy, unnest([lower(candidate), lower("order"), 'c' || cycle || '_' || (CASE WHEN length(candidate) < 2 THEN '0' ELSE '' END) || candidate, 'cc' || cycle || '_' || (CASE WHEN length(candidate) < 2 THEN '0' ELSE '' END) || candidate]) AS form FROM c),
 m AS (SELECT DISTINCT pos_key, k.* FROM f JOIN k ON form = lower(about) AND lower(about) <> 'none' WHERE in_cycle = '' OR in_cycle = cy)"""


def slots_and_corrections(spark, sf_dir):
    return relation(spark, sf_dir, SLOTS.replace('"', "`")), relation(spark, sf_dir, CORRECTIONS).withColumn("at", F.col("pos") * 8 + F.col("line"))


@register("jn3_corrections", f"WITH {MATCHED} SELECT pos_key, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos FROM m GROUP BY pos_key")
def corrections(spark, sf_dir):
    return joins.correction_counts(*slots_and_corrections(spark, sf_dir))


@register("ag11_overlay", f"""WITH {MATCHED}, o AS (SELECT *, pos * 8 + line AS spot FROM m) SELECT pos_key, struct_extract(max({{'at': spot, 'v': corrected_candidate}}) FILTER (WHERE corrected_candidate <> ''), 'v') AS corrected_candidate, struct_extract(max({{'at': spot, 'v': corrected_decision}}) FILTER (WHERE corrected_decision <> 'n/a'), 'v') AS corrected_decision FROM o GROUP BY pos_key""")
def overlay(spark, sf_dir):
    return joins.corrected(*slots_and_corrections(spark, sf_dir), ["corrected_candidate", "corrected_decision"], pos="at")


@register("ag12_reasons", f"WITH {MATCHED} SELECT pos_key, trim(coalesce(string_agg(corrected_candidate, ' ' ORDER BY pos * 8 + line, corrected_candidate), '')) AS reason FROM m GROUP BY pos_key")
def reasons(spark, sf_dir):
    return joins.correction_reasons(*slots_and_corrections(spark, sf_dir), ["corrected_candidate"], pos="at")


@register("jn4_merge_history", f"""WITH h AS ({HISTORY}), u AS (SELECT *, 'p' AS patch, 1 AS copy FROM h UNION ALL SELECT commit, parent, source_id, line, source_pos, CASE WHEN line % 7 = 0 THEN 'x' END, kind, tree, 'p ', 2 FROM h), r AS (SELECT *, row_number() OVER (PARTITION BY commit ORDER BY CASE WHEN coalesce(reverts_commit, '') = '' THEN 1 ELSE 0 END, copy) AS k FROM u)
 SELECT commit, reverts_commit, CAST(copy AS BIGINT) AS copy FROM r WHERE k = 1""")
def merge_history(spark, sf_dir):
    h = relation(spark, sf_dir, HISTORY).drop("source_pos")
    a = h.select("commit", F.lit("p").alias("patch"), "reverts_commit", F.lit(1).alias("source_pos"), "line")
    b = h.select("commit", F.lit("p ").alias("patch"), F.when(F.col("line") % 7 == 0, "x").alias("reverts_commit"), F.lit(2).alias("source_pos"), "line")
    return joins.merge_history(a.unionByName(b)).select("commit", "reverts_commit", F.col("source_pos").cast("long").alias("copy"))


REJECTED = f"SELECT event_id AS pos, CASE WHEN event_id % 2 = 0 THEN 'rejected' ELSE 'accepted' END AS disposition, {COMMIT.format('event_id')} AS candidate_commit, {COMMIT.format('event_id + 1')} AS restoration_commit FROM {{events}}"


@register("jn6_proven_reverts", f"""WITH h AS ({HISTORY}), c AS ({REJECTED}) SELECT pos, CASE WHEN disposition = 'accepted' OR h.reverts_commit = candidate_commit THEN candidate_commit END AS linked_commit, NOT (disposition = 'accepted' OR coalesce(h.reverts_commit = candidate_commit, false)) AS unproven FROM c LEFT JOIN h ON h.commit = restoration_commit""")
def proven(spark, sf_dir):
    return joins.proven(relation(spark, sf_dir, REJECTED), relation(spark, sf_dir, HISTORY)).select("pos", "linked_commit", "unproven")


@register("jn9_exact_parent_reverts", f"WITH h AS ({HISTORY}) SELECT a.commit, a.parent AS reverts FROM h a JOIN h b ON a.parent = b.commit JOIN h c ON b.parent = c.commit WHERE a.tree = c.tree")
def parent_reverts(spark, sf_dir):
    return joins.exact_parent_reverts(relation(spark, sf_dir, HISTORY).withColumn("parents", F.array("parent")))


RECORDS = "SELECT event_type AS source_id, CAST(event_id AS STRING) AS record_id, CAST(user_id % 50 AS STRING) AS created_at, md5(CAST(user_id AS STRING)) AS sha256 FROM {events}"


PINS = f"SELECT source_id, CASE WHEN length(source_id) % 2 = 0 THEN min(record_id) ELSE 'none' END AS pin FROM ({RECORDS}) p GROUP BY source_id"


@register("jn8_latest_record", f"WITH r AS ({RECORDS}), p AS ({PINS}) SELECT r.source_id, CASE WHEN length(r.source_id) % 2 = 0 THEN min(record_id) ELSE arg_max(record_id, created_at || '|' || record_id) END AS record_id FROM r GROUP BY r.source_id")
def latest(spark, sf_dir):
    """Each source whose name has an even length is pinned to its least record id's digest, the others to one that isn't there."""
    r = relation(spark, sf_dir, RECORDS).withColumn("sha256", F.md5(F.col("record_id").cast("binary")))
    registry = relation(spark, sf_dir, PINS).select("source_id", F.md5(F.col("pin").cast("binary")).alias("sha256"))
    return joins.latest_record(r, registry).select("source_id", "record_id")


@register("ag_counts", f"""WITH l AS ({LEDGER}) SELECT 'campaign_id' AS what, campaign_id AS value, count(*) AS n FROM l GROUP BY 2 UNION ALL SELECT 'assigned_split', assigned_split, count(*) FROM l GROUP BY 2 UNION ALL SELECT 'campaign_id|assigned_split', campaign_id || '|' || assigned_split, count(*) FROM l GROUP BY 2""")
def counts(spark, sf_dir):
    return groups.counts(relation(spark, sf_dir, LEDGER), ["campaign_id", "assigned_split"], [("campaign_id", "assigned_split")])


@register("ag3_conditional_counts", f"WITH l AS ({LEDGER}) SELECT count_if({VERDICT} = 'accepted') AS accepted, count_if({sql_clean('hypothesis')} <> '') AS with_hypothesis, count(*) AS n FROM l")
def conditional(spark, sf_dir):
    return relation(spark, sf_dir, LEDGER).agg(F.count_if(ledger.disposition(F.col("decision")) == "accepted").alias("accepted"), F.count_if(ledger.clean(F.col("hypothesis")) != "").alias("with_hypothesis"), F.count("*").alias("n"))


@register("ag4_reconcile_splits", f"""WITH l AS ({LEDGER}), f AS (SELECT *, mechanism || hypothesis || cycle || candidate AS fp, CASE assigned_split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 WHEN 'test' THEN 2 ELSE 3 END AS p FROM l), o AS (SELECT fp, assigned_split AS s, evaluation_tier AS t FROM (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY p DESC, pos) AS k FROM f) x WHERE k = 1)
 SELECT pos, s AS assigned_split, t AS evaluation_tier FROM f JOIN o ON f.fp = o.fp""")
def reconcile(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER).withColumn("fp", F.concat("mechanism", "hypothesis", "cycle", "candidate"))
    return groups.reconcile_splits(d, "fp", "pos").select("pos", "assigned_split", "evaluation_tier")


AT = "strftime(ts + CASE WHEN event_id % 2 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN '+02:00' ELSE 'Z' END"


@register("ag5_latest_time", f"SELECT event_type, struct_extract(max({{'t': date_trunc('second', ts), 's': {AT}}}), 's') AS latest FROM {{events}} GROUP BY event_type")
def latest_time(spark, sf_dir):
    """Each second time is written with another offset, so that the order of the texts isn't that of the times."""
    east = F.col("event_id") % 2 == 0
    local = F.date_format(F.when(east, F.col("ts") + F.expr("INTERVAL 2 HOURS")).otherwise(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss")
    d = table(spark, sf_dir, "events").select("event_type", F.concat(local, F.when(east, "+02:00").otherwise("Z")).alias("at"))
    return groups.latest_time(d, "event_type", "at")


@register("ag7_split_crossing", f"""WITH l AS ({LEDGER}), k AS (SELECT 'mechanism' AS kind, mechanism AS key, assigned_split AS s FROM l UNION ALL SELECT 'place', campaign_id || cycle || candidate || CAST(pos % 997 AS STRING), assigned_split FROM l) SELECT kind, key, count(DISTINCT s) AS n FROM k GROUP BY kind, key HAVING count(DISTINCT s) > 1""")
def crossing(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER).withColumn("place", F.concat("campaign_id", "cycle", "candidate", (F.col("pos") % 997).cast("string")))
    return groups.crossing(d, ["mechanism", "place"], "assigned_split")


@register("ag8_duplicates", "SELECT md5(text) AS digest, count(*) AS n FROM {documents} GROUP BY 1 HAVING count(*) > 1")
def duplicates(spark, sf_dir):
    return groups.duplicates(table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("digest")), "digest")


@register("wn4_terminal_rows", f"WITH l AS ({LEDGER}), w AS (SELECT *, max(pos) OVER g AS m, bool_or({VERDICT} = 'accepted' AND total > 450000) OVER g AS a FROM l WINDOW g AS (PARTITION BY campaign_id, cycle, candidate)) SELECT pos, pos = m AS \"last\", pos = m AND NOT a AS terminal_no_win FROM w")
def terminal(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER).withColumn("cycle", F.concat("cycle", F.lit("."), "candidate"))
    return groups.terminal(d, "campaign_id", "cycle", "pos", (ledger.disposition(F.col("decision")) == "accepted") & (F.col("total") > 450000)).select("pos", "last", "terminal_no_win")


@register("tx8_collapse", "SELECT sha256(trim(regexp_replace(text, '[ \t]+', ' ', 'g'))) AS fp, min(doc_id) AS doc_id, count(*) AS n, list_sort(list(DISTINCT source)) AS refs FROM {documents} GROUP BY 1")
def collapse(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("fp", F.sha2(ledger.stripped(F.regexp_replace("text", "[ \t]+", " ")).cast("binary"), 256))
    return groups.collapse(d, "fp", "doc_id", "source")


@register("sp8_sampler", f"WITH l AS ({LEDGER}) SELECT pos FROM (SELECT pos, row_number() OVER (PARTITION BY campaign_id, cycle, mechanism ORDER BY pos) AS k FROM l WHERE assigned_split = 'train') x WHERE k <= 3")
def sampler(spark, sf_dir):
    return groups.capped(relation(spark, sf_dir, LEDGER).where("assigned_split = 'train'"), ["campaign_id", "cycle", "mechanism"], ["pos"], 3).select("pos")


@register("sp1_cycle_state", f"""WITH l AS ({LEDGER}), w AS (SELECT pos, row_number() OVER g AS slot, coalesce(bool_or({VERDICT} = 'accepted') OVER (PARTITION BY campaign_id, cycle, candidate ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS b FROM l WINDOW g AS (PARTITION BY campaign_id, cycle, candidate ORDER BY pos)) SELECT pos, slot, slot <= 24 AND NOT b AS allowed FROM w""")
def cycle_state(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER).withColumn("cycle", F.concat("cycle", F.lit("."), "candidate"))
    return groups.cycle_state(d, "campaign_id", "cycle", "pos", ledger.disposition(F.col("decision")) == "accepted").select("pos", F.col("slot").cast("long").alias("slot"), "allowed")


# limits that no mean of tenths or thirds is equal to
GATE = """WITH r AS (SELECT l_orderkey AS k, 100 * (l_extendedprice - l_extendedprice * (1 - l_discount / 3)) / l_extendedprice AS p, l_quantity / 10 AS t FROM {lineitem}), g AS (SELECT k, avg(p) AS mp, min(p) AS lp, avg(t) AS mt, min(t) AS lt, count(*) AS reps FROM r GROUP BY k)
 SELECT k, round(mp, 6) AS mean_pct, reps, mp >= 1.4999 OR (mt >= 2.9999 AND mp > 0) AS by_mean, lp >= 1.4999 OR (lt >= 2.9999 AND lp > 0) AS by_each, lp >= 1.4999 AND reps >= 2 AS by_all FROM g"""


@register("sp2_accept_gate", GATE)
def gate(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("base_ms"), (F.col("l_extendedprice") * (1 - F.col("l_discount") / 3)).alias("ms"), (F.col("l_quantity") / 10).alias("tok_gain"))
    one = lambda mode: groups.accept_gate(d, ["k"], mode, 1.4999, 2.9999)
    each, every = (one(m).select("k", F.col("accepted").alias(f"by_{m}")) for m in ("each", "all"))
    return one("mean").select("k", F.round("mean_pct", 6).alias("mean_pct"), "reps", F.col("accepted").alias("by_mean")).join(each, "k").join(every, "k")


@register("sp3_worst_point", "WITH d AS (SELECT l_orderkey AS k, l_linenumber AS n, 100 * (l_extendedprice * (1 + l_tax) - l_extendedprice) / l_extendedprice AS d FROM {lineitem}) SELECT k, round(max(d), 6) AS worst_pct, CAST(struct_extract(max({'d': d, 'n': n}), 'n') AS BIGINT) AS worst_point FROM d GROUP BY k")
def worst(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("b"), (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("v"))
    return groups.worst_points(d, ["k"], "n", "b", "v").select("k", F.round("worst_pct", 6).alias("worst_pct"), F.col("worst_point").cast("long").alias("worst_point"))


@register("sp6_summary", """SELECT l_returnflag AS flag, round(exp(avg(ln(CASE WHEN l_discount > 0 THEN 1 + l_discount END))), 6) AS geomean, round(min(CASE WHEN l_discount > 0 THEN 1 + l_discount END), 6) AS worst, round(avg(CASE WHEN l_discount > 0 THEN 1.0 ELSE 0.0 END), 6) AS valid_rate, count_if(l_tax > 0.04) AS n_accepted, round(avg(CASE WHEN l_tax > 0.04 THEN 1.0 ELSE 0.0 END), 6) AS accept_rate, round(avg(CASE WHEN l_tax > 0.06 AND NOT l_discount > 0 THEN 1.0 ELSE 0.0 END), 6) AS false_claim_rate FROM {lineitem} GROUP BY 1""")
def summary(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), (1 + F.col("l_discount")).alias("s"), "l_discount", "l_tax")
    g = groups.summary(d, ["flag"], "s", F.col("l_discount") > 0, F.col("l_tax") > 0.04, F.col("l_tax") > 0.06)
    return g.select("flag", F.round("geomean", 6).alias("geomean"), F.round("worst", 6).alias("worst"), F.round("valid_rate", 6).alias("valid_rate"), "n_accepted", F.round("accept_rate", 6).alias("accept_rate"), F.round("false_claim_rate", 6).alias("false_claim_rate"))


@register("sp4_combo", f"""WITH l AS ({LEDGER}) SELECT pos, CASE WHEN {VERDICT} <> 'rejected' THEN 'not rejected' WHEN coalesce(oracle_result, '') <> 'pass' AND coalesce(oracle_result, '') <> 'did not pass' THEN 'unsound' WHEN cycle = '3' THEN 'conflicting' WHEN total > 200000 THEN 'eligible' ELSE 'no gain' END AS combo FROM l""")
def combo(spark, sf_dir):
    return relation(spark, sf_dir, LEDGER).select("pos", groups.combo_eligible(ledger.disposition(F.col("decision")), ledger.correctness(F.col("oracle_result")), F.col("total") - 200000, F.col("cycle") == "3").alias("combo"))
