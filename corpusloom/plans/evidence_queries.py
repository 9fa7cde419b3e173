"""Queries on the candidate builder, source records, provenance checks and training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import patches
from corpusloom.operators import builder, episodes, groups, joins, provenance, sampling
from corpusloom.plans.episode_queries import CANDIDATES, EVENTS, NAME, candidates, rendered_sql
from corpusloom.plans.ledger_queries import REJECTED
from corpusloom.plans.registry import HISTORY, LEDGER, register, relation, table
from corpusloom.sources import tables

AT = "2026-01-01T00:00:00Z"
CAMPAIGNS = "SELECT DISTINCT o_orderpriority AS campaign_id, CASE WHEN o_orderpriority LIKE '1%' THEN 'train' ELSE 'validation' END AS assigned_split, 'train' AS evaluation_tier FROM {orders}"
CYCLES = "SELECT DISTINCT o_orderpriority AS campaign_id, '3' AS cycle, 'test' AS assigned_split, 'in_arch' AS evaluation_tier FROM {orders} WHERE o_orderpriority < '3'"


@register("pr11_assigned_splits", f"WITH l AS ({LEDGER}) SELECT pos, CASE WHEN campaign_id < '3' AND cycle = '3' THEN 'test' WHEN campaign_id LIKE '1%' THEN 'train' ELSE 'validation' END AS assigned_split, CASE WHEN campaign_id < '3' AND cycle = '3' THEN 'in_arch' ELSE 'train' END AS evaluation_tier FROM l")
def assigned(spark, sf_dir):
    rows = relation(spark, sf_dir, LEDGER).select("pos", "campaign_id", "cycle")
    return builder.assigned(rows, relation(spark, sf_dir, CAMPAIGNS), relation(spark, sf_dir, CYCLES)).select("pos", "assigned_split", "evaluation_tier")


@register("pr14_context", """SELECT c_custkey AS pos, 'Target: ' || c_mktsegment || '. Hardware: sku' || CAST(c_nationkey AS VARCHAR) || ' (a' || CAST(c_nationkey % 3 AS VARCHAR) || '). Boundary: Engine. Workload: {"batch": ' || CAST(c_nationkey AS VARCHAR) || '}.'
 || CASE c_custkey % 3 WHEN 0 THEN '' ELSE ' Dispatch scope: d' || CAST(c_custkey % 3 AS VARCHAR) || '.' END || CASE WHEN c_custkey % 2 = 0 THEN ' Affected files: src/x.cu.' ELSE '' END AS context, ['a' || CAST(c_nationkey % 3 AS VARCHAR)] AS architectures, 'x' AS op_family FROM {customer}""")
def context(spark, sf_dir):
    text = lambda c: F.col(c).cast("string")
    d = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), F.col("c_mktsegment").alias("target"), F.concat(F.lit("sku"), text("c_nationkey")).alias("hardware_sku"), F.concat(F.lit("a"), (F.col("c_nationkey") % 3).cast("string")).alias("architecture"), F.lit("Engine").alias("boundary"), F.lit("x").alias("op_family"),
        F.concat(F.lit('{"batch": '), text("c_nationkey"), F.lit("}")).alias("workload"), F.when(F.col("c_custkey") % 3 == 0, "N/A").otherwise(F.concat(F.lit("d"), (F.col("c_custkey") % 3).cast("string"))).alias("dispatch"), F.when(F.col("c_custkey") % 2 == 0, "src/x.cu").alias("files"),
    )
    return d.select("pos", builder.context().alias("context"), builder.scope().alias("s")).select("pos", "context", "s.architectures", "s.op_family")


@register("pr22_correction_text", """WITH c AS (SELECT l_orderkey AS k, l_linenumber % 2 AS p, l_linenumber AS n, 'Correction from s' || CAST(l_linenumber % 2 AS VARCHAR) || '.' || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE ' issue: ' || l_returnflag END || ' corrected claim: ' || l_linestatus AS t FROM {lineitem})
 SELECT k AS pos_key, string_agg(t, chr(10) ORDER BY p, n, t) AS correction_text FROM c GROUP BY k""")
def correction_text(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pos_key"), (F.col("l_linenumber") % 2).alias("source_pos"), F.col("l_linenumber").alias("line"), F.concat(F.lit("s"), (F.col("l_linenumber") % 2).cast("string")).alias("source_id"), F.when(F.col("l_linenumber") % 3 == 0, "n/a").otherwise(F.col("l_returnflag")).alias("issue"), F.col("l_linestatus").alias("corrected_claim"))
    return builder.correction_text(l)


@register("fl7_size_limits", f"""SELECT doc_id, CASE WHEN length(text) > 1000 OR 2 * length(text) > 1500 THEN 0 ELSE length(text) END AS n, CASE WHEN length(text) > 1000 THEN '{builder.LIMITATIONS["patch"]}' WHEN 2 * length(text) > 1500 THEN '{builder.LIMITATIONS["preimage"]}' ELSE '' END AS limitation FROM {{documents}}""")
def limits(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("patch"), F.concat("text", "text").alias("preimage"), F.lit(None).cast("array<string>").alias("limitations"))
    return builder.limited(d, 1000, 1500).select("doc_id", F.length("patch").cast("long").alias("n"), F.array_join("limitations", " ").alias("limitation"))


@register("fl6_seed_omissions", f"WITH c AS ({REJECTED}) SELECT 'seed' AS reason, count(*) AS n FROM c WHERE pos % 7 = 0 HAVING count(*) > 0 UNION ALL SELECT 'no win', count(*) FROM c WHERE pos % 7 <> 0 AND disposition = 'rejected' HAVING count(*) > 0")
def omissions(spark, sf_dir):
    c = relation(spark, sf_dir, REJECTED)
    kept = builder.without_seed(c, c.where("pos % 7 = 0").select("candidate_commit"))
    every = c.select("pos", "disposition").join(kept.select("pos", F.lit(True).alias("kept")), "pos", "left")
    return builder.omissions(every, {"seed": F.col("kept").isNull(), "no win": F.col("kept") & (F.col("disposition") == "rejected"), "never": F.lit(False)})


@register("jn5_history", f"WITH h AS ({HISTORY}), c AS ({REJECTED}) SELECT pos, a.tree AS raw_patch, a.source_id AS history_source, b.source_id AS restoration_source, b.reverts_commit AS restores FROM c LEFT JOIN h a ON candidate_commit = a.commit LEFT JOIN h b ON restoration_commit = b.commit")
def history(spark, sf_dir):
    h = relation(spark, sf_dir, HISTORY).select("commit", F.col("tree").alias("patch"), "source_id", "reverts_commit")
    return builder.with_history(relation(spark, sf_dir, REJECTED), h).select("pos", "raw_patch", "history_source", "restoration_source", "restores")


DAY = "'2026-01-' || lpad(CAST({0} + 1 AS VARCHAR), 2, '0') || CASE WHEN {0} % 2 = 0 THEN 'T01:30:00+02:00' ELSE 'T00:00:00+00:00' END"


@register("jn7_evidence", f"""WITH e AS (SELECT c_custkey AS pos_key, c_nationkey AS a, (c_nationkey + 1) % 25 AS b FROM {{customer}}), t AS (SELECT *, {DAY.format("a")} AS ta, {DAY.format("b")} AS tb FROM e)
 SELECT pos_key, ['n' || CAST(a AS VARCHAR), 'n' || CAST(b AS VARCHAR)] AS source_ids, ['raw:' || CAST(a AS VARCHAR), 'raw:' || CAST(b AS VARCHAR)] AS snapshot_refs, CASE WHEN CAST(ta AS TIMESTAMPTZ) > CAST(tb AS TIMESTAMPTZ) THEN ta ELSE tb END AS evidence_cutoff FROM t""")
def evidence(spark, sf_dir):
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos_key"), F.array(name(F.col("c_nationkey")), name((F.col("c_nationkey") + 1) % 25), name(F.col("c_nationkey"))).alias("source_ids"))
    n = table(spark, sf_dir, "nation").withColumn("day", F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0"))
    latest = n.select(name(F.col("n_nationkey")).alias("source_id"), F.concat(F.lit("raw:"), F.col("n_nationkey").cast("string")).alias("record_id"), F.concat(F.lit("2026-01-"), "day", F.lit("T00:00:00+00:00")).alias("created_at"))
    registry = n.select(name(F.col("n_nationkey")).alias("source_id"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("2026-01-"), "day", F.lit("T01:30:00+02:00"))).otherwise("n/a").alias("source_date"))
    return builder.evidence(c, latest, registry)


@register("jn10_campaign_sources", """WITH n AS (SELECT n_name AS campaign_id, CAST(n_nationkey AS VARCHAR) AS k FROM {nation}) SELECT campaign_id, 'ledger' AS role, CAST(0 AS INT) AS place, 'l' || k AS source_id FROM n UNION ALL SELECT campaign_id, 'history', 0, 'h' FROM n UNION ALL SELECT campaign_id, 'history', 1, 'h' || k FROM n UNION ALL SELECT campaign_id, 'correction', 0, 'c' || k FROM n""")
def sources(spark, sf_dir):
    k = F.col("n_nationkey").cast("string")
    c = table(spark, sf_dir, "nation").select(F.col("n_name").alias("campaign_id"), F.array(F.concat(F.lit("l"), k)).alias("ledger_source_ids"), F.array(F.lit("h"), F.concat(F.lit("h"), k)).alias("history_source_ids"), F.array().cast("array<string>").alias("context_source_ids"), F.array(F.concat(F.lit("c"), k)).alias("correction_source_ids"))
    return builder.campaign_sources(c)


@register("fl4_refused_sources", """WITH d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS source_id, CASE WHEN doc_id % 2 = 0 THEN 'ledger' ELSE 'context' END AS role FROM {documents}) SELECT role, source_id, r AS reason FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'not registered' WHEN doc_id % 5 = 0 THEN 'live' WHEN doc_id % 7 = 0 THEN 'not collected' WHEN doc_id % 11 = 0 THEN 'no raw record' WHEN doc_id % 4 = 0 THEN 'not a CSV ledger' END AS r FROM d) x WHERE r IS NOT NULL""")
def refused(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source_id"))
    at = F.col("doc_id")
    asked = d.select("source_id", F.when(at % 2 == 0, "ledger").otherwise("context").alias("role"))
    registry = d.where("doc_id % 3 <> 0").select("source_id", F.when(at % 5 == 0, "live_reference").otherwise("official").alias("source_class"), F.when(at % 7 == 0, "failed").otherwise("collected").alias("ingestion_status"))
    records = d.where("doc_id % 11 <> 0").select("source_id", F.when(at % 4 == 0, "x.txt").otherwise("x.CSV").alias("relative_path"))
    return builder.refused(asked, registry, records)


@register("pr18_source_records", """WITH p AS (SELECT page_id, CAST(page_id AS VARCHAR) AS k, url, sha256(html) AS h, CAST(strlen(html) AS BIGINT) AS b FROM {pages})
 SELECT 'w' || k AS source_id, 'official' AS source_class, url, CAST(NULL AS VARCHAR) AS path, CAST(NULL AS VARCHAR) AS revision, CASE WHEN page_id % 3 <> 0 THEN h END AS sha256, CASE WHEN page_id % 3 <> 0 THEN b END AS bytes, CASE WHEN page_id % 3 <> 0 THEN 'collected' ELSE 'failed' END AS ingestion_status FROM p
 UNION ALL SELECT 'r' || k, 'closed', NULL, CASE WHEN page_id % 3 <> 1 THEN 'src/' || k END, CASE page_id % 3 WHEN 0 THEN 'rev' WHEN 1 THEN 'v' || k ELSE 'closed' END, h, b, 'collected' FROM p
 UNION ALL SELECT 'a' || k, 'authored_structure', NULL, 'n/' || k || '.jsonl', 'corpusloom', h, b, 'collected' FROM p
 UNION ALL SELECT 'l' || k, 'live_reference', NULL, 'live/' || k, 'seen', NULL, NULL, 'live_reference' FROM p""")
def source_records(spark, sf_dir):
    k = F.col("page_id").cast("string")
    p = table(spark, sf_dir, "pages").select("page_id", k.alias("k"), "url", F.lit("t").alias("title"), F.sha2(F.col("html").cast("binary"), 256).alias("sha256"), F.octet_length("html").cast("long").alias("bytes"))
    named = lambda x: p.withColumn("source_id", F.concat(F.lit(x), "k"))
    web = named("w").withColumns({"status": F.when(F.col("page_id") % 3 != 0, "collected").otherwise("failed"), "mime_type": F.lit("text/html"), "local_relative_path": F.lit("x")})
    kind = F.when(F.col("page_id") % 3 == 0, "git_file").when(F.col("page_id") % 3 == 1, "git_range").otherwise("local_file")
    closed = named("r").withColumns({"kind": kind, "path": F.concat(F.lit("src/"), "k"), "revision": F.lit("rev"), "version": F.concat(F.lit("v"), "k"), "closed_at": F.lit("closed"), "source_class": F.lit("closed")})
    own = named("a").withColumn("path", F.concat(F.lit("n/"), "k", F.lit(".jsonl")))
    live = named("l").withColumns({"path": F.concat(F.lit("live/"), "k"), "repository": F.lit("r"), "observed_revision": F.lit("seen"), "host_label": F.lit("h")})
    every = provenance.web_sources(web, AT).unionByName(provenance.repository_sources(closed, "repo", AT)).unionByName(provenance.authored_sources(own, AT, "corpusloom")).unionByName(provenance.live_references(live, AT))
    return every.select("source_id", "source_class", "locator.url", "locator.path", "locator.revision", "sha256", "bytes", "ingestion_status")


@register("sc15_third_party", """WITH n AS (SELECT n_nationkey AS i, CAST(n_nationkey AS VARCHAR) AS k FROM {nation}) SELECT 'r' || k AS source_id, 'https://github.com/o/' || k AS url, 'application/vnd.git.repository' AS mime_type FROM n
 UNION ALL SELECT 'r' || k || '--license', 'https://raw.githubusercontent.com/o/' || k || '/v1/LICENSE', 'text/plain' FROM n WHERE i % 3 = 0 UNION ALL SELECT 'r' || k || '--docs-readme-md', 'https://raw.githubusercontent.com/o/' || k || '/v1/docs/README.md', 'text/markdown' FROM n WHERE i % 3 = 0""")
def third_party(spark, sf_dir):
    k = F.col("n_nationkey").cast("string")
    state = F.when(F.col("n_nationkey") % 3 == 0, "compatible").when(F.col("n_nationkey") % 3 == 1, "metadata_only")
    r = table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), k).alias("source_id"), F.lit("t").alias("title"), F.concat(F.lit("https://github.com/o/"), k).alias("url"), F.lit("v1").alias("revision"), state.alias("license_status"), F.lit("MIT").alias("license"), F.array(F.lit("LICENSE"), F.lit("docs/README.md")).alias("allowed_paths"))
    records, wanted = provenance.third_party(r, AT)
    return records.select("source_id", "locator.url", "mime_type").unionByName(wanted.select("source_id", "url", "mime_type"))


@register("sc11_inline_evidence", """WITH n AS (SELECT n_nationkey, '{"a":' || CAST(n_nationkey AS VARCHAR) || ',"z":"' || n_name || '"}' AS content FROM {nation}) SELECT n_nationkey AS source_id, content, sha256(content) AS sha256, CAST(strlen(content) AS BIGINT) AS bytes FROM n""")
def inline(spark, sf_dir):
    return provenance.inline_evidence(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("z"), F.col("n_nationkey").alias("a")))


@register("va3_manifest_checks", """WITH d AS (SELECT *, doc_id % 10 <> 0 AND doc_id % 13 <> 0 AS there FROM {documents}), k AS (SELECT CAST(doc_id AS VARCHAR) AS key, * FROM d) SELECT 'file' AS "check", key FROM k WHERE NOT there UNION ALL SELECT 'digest', key FROM k WHERE there AND doc_id % 7 = 0 UNION ALL SELECT 'size', key FROM k WHERE there AND doc_id % 5 = 1
 UNION ALL SELECT 'layer', key FROM k WHERE there AND doc_id % 3 = 0 UNION ALL SELECT 'one digest', 'p/shared' FROM d WHERE doc_id % 10 = 0 HAVING min(text) <> max(text)""")
def manifest_checks(spark, sf_dir):
    i, sha = F.col("doc_id"), F.sha2(F.col("text").cast("binary"), 256)
    path = F.when(i % 10 == 0, "p/shared").otherwise(F.concat(F.lit("p/"), i.cast("string")))
    d = table(spark, sf_dir, "documents").select("doc_id", path.alias("relative_path"), sha.alias("sha256"), F.col("n_chars").cast("long").alias("bytes"))
    m = d.withColumns({"record_id": i, "layer": F.when(i % 3 == 0, "normalized").otherwise("raw")})
    found = d.where("doc_id % 10 <> 0 and doc_id % 13 <> 0").select(F.col("relative_path").alias("path"), F.when(i % 7 == 0, "x").otherwise(F.col("sha256")).alias("sha256"), F.when(i % 5 == 1, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"))
    return provenance.manifest_checks(m, found, "raw").select("check", "key")


@register("va5_restoration_links", "WITH l AS (SELECT user_id, max(event_id) AS e FROM {events} GROUP BY 1) SELECT CAST(user_id AS VARCHAR) AS key FROM l WHERE e % 2 = 0 AND e % 3 <> 0")
def restorations(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("commit"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 2 == 0, "restoration").otherwise("retained").alias("kind"), F.when(F.col("event_id") % 3 == 0, "x").alias("reverts_commit"))
    return provenance.restoration_checks(e).select("key")


@register("va16_registry_checks", """WITH d AS (SELECT doc_id AS i, CAST(doc_id AS VARCHAR) AS key FROM {documents}), r AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE i % 9 = 0) SELECT 'source id' AS "check", key FROM r GROUP BY key HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'live', key FROM r WHERE i % 4 = 0 AND i % 8 = 0
 UNION ALL SELECT 'provenance', key FROM r WHERE i % 4 = 1 AND i % 5 = 0 UNION ALL SELECT 'license', key FROM r WHERE i % 4 = 2 AND i % 3 <> 1""")
def registry_checks(spark, sf_dir):
    i = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select(i)
    r = d.unionByName(d.where("doc_id % 9 = 0"))
    kinds = F.when(i % 4 == 0, "live_reference").when(i % 4 == 1, "official").when(i % 4 == 2, "third_party_licensed").otherwise("authored")
    state = F.when(i % 3 == 0, "denied").when(i % 3 == 1, "compatible")
    r = r.select(i.cast("string").alias("source_id"), kinds.alias("source_class"), F.lit("collected").alias("ingestion_status"), F.struct(F.lit("u").alias("url")).alias("locator"), F.when(i % 5 != 0, "s").alias("sha256"), F.lit("p").alias("local_relative_path"), F.struct(state.alias("status")).alias("license"))
    return provenance.registry_checks(r, d.where("doc_id % 8 = 0").select(i.cast("string").alias("source_id"))).select("check", "key")


def cards(spark, sf_dir):
    """A card for each region, with a fact for each nation."""
    n = F.col("n_nationkey")
    when = lambda k, v: F.when(n % k != 0, v)
    fact = F.struct(n.cast("string").alias("fact_id"), F.array(F.concat(F.lit("s"), (n % 4).cast("string")), F.lit("s9")).alias("source_refs"), when(2, "cc").alias("toolchain"), when(3, "b1").alias("build_revision"), when(5, "sku").alias("hardware_sku"), F.when(n % 7 == 0, "").otherwise("w").alias("workload_key"))
    g = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("string").alias("architecture_id")).agg(F.collect_list(fact).alias("facts"))
    return g.select("architecture_id", F.col("facts").alias("immutable_facts"), F.col("facts").alias("compiler_observations"), F.col("facts").alias("device_measurements"))


@register("va15_fact_checks", """WITH f AS (SELECT n_nationkey AS n, CAST(n_regionkey AS VARCHAR) || '/' || CAST(n_nationkey AS VARCHAR) AS key FROM {nation}) SELECT 'compiler fact' AS "check", key FROM f WHERE n % 2 = 0 OR n % 3 = 0 UNION ALL SELECT 'device fact', key FROM f WHERE n % 5 = 0 OR n % 7 = 0""")
def fact_checks(spark, sf_dir):
    return provenance.fact_checks(cards(spark, sf_dir)).select("check", "key")


@register("ep14_card_refs", "WITH f AS (SELECT CAST(n_regionkey AS VARCHAR) AS card, 's' || CAST(n_nationkey % 4 AS VARCHAR) AS ref FROM {nation} UNION ALL SELECT CAST(n_regionkey AS VARCHAR), 's9' FROM {nation}) SELECT card, list_sort(list(DISTINCT ref)) AS refs FROM f GROUP BY card")
def card_refs(spark, sf_dir):
    return provenance.card_refs(cards(spark, sf_dir))


@register("ep14_delta_sources", "SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS key, 'unknown source ' || CAST(n_regionkey AS VARCHAR) AS message FROM {nation} WHERE n_regionkey % 2 = 1")
def delta_sources(spark, sf_dir):
    d = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("delta_id"), F.array(F.col("n_regionkey").cast("string")).alias("source_refs"))
    return provenance.unknown_sources(d, table(spark, sf_dir, "region").where("r_regionkey % 2 = 0").select(F.col("r_regionkey").cast("string").alias("source_id"))).select("key", "message")


@register("va17_evaluation_checks", """WITH c AS (SELECT DISTINCT conv_id AS i FROM {conversations}) SELECT 'ids' AS "check", CAST(i AS VARCHAR) AS key, CASE WHEN i % 5 = 0 THEN 'no prompt' ELSE 'no label' END AS message FROM c WHERE (i % 5 = 0) <> (i % 7 = 0) UNION ALL SELECT 'label keys', CAST(i AS VARCHAR), 'a label is public' FROM c WHERE i % 5 <> 0 AND i % 3 = 0""")
def evaluation_checks(spark, sf_dir):
    i = F.col("id")
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")).distinct().withColumn("split", F.when(i % 2 == 0, "validation").otherwise("test"))
    public = c.where("id % 5 <> 0").withColumn("json", F.to_json(F.struct("id", F.when(i % 3 == 0, "x").alias("outcome"))))
    return provenance.evaluation_checks(public, c.where("id % 7 <> 0"))


@register("va19_quality_checks", """SELECT 'hidden reasoning' AS "check", CAST(doc_id AS VARCHAR) AS key FROM {documents} WHERE doc_id % 3 <> 1 UNION ALL SELECT 'secret scan', CAST(doc_id AS VARCHAR) FROM {documents} WHERE doc_id % 5 = 0""")
def quality_checks(spark, sf_dir):
    i = F.col("doc_id")
    quality = F.struct(F.when(i % 3 == 0, True).when(i % 3 == 1, False).alias("contains_hidden_chain_of_thought"), F.when(i % 5 == 0, "failed").otherwise("passed").alias("secret_scan"))
    return provenance.quality_checks(table(spark, sf_dir, "documents").select(i.alias("episode_id"), quality.alias("quality"))).select("check", "key")


FILE_SECRET_SQL = " UNION ALL ".join(f"SELECT path AS key, 'possible {n}' AS message FROM f WHERE regexp_matches(content, '{p}')" for n, p in provenance.FILE_SECRETS.items())


@register("fl13_file_secrets", "WITH f AS (SELECT 'd/' || CAST(doc_id AS VARCHAR) AS path, text || CASE WHEN doc_id % 9 = 0 THEN ' run ssh -p22 user' || chr(64) || 'host' ELSE '' END || CASE WHEN doc_id % 11 = 0 THEN ' AKIA' || repeat('Q', 16) ELSE '' END AS content FROM {documents} WHERE doc_id % 4 <> 0) " + FILE_SECRET_SQL)
def file_secrets(spark, sf_dir):
    i = F.col("doc_id")
    content = F.concat("text", F.when(i % 9 == 0, " run ssh -p22 user@host").otherwise(""), F.when(i % 11 == 0, " AKIA" + "Q" * 16).otherwise(""))
    path = F.concat(F.lit("d/"), i.cast("string"), F.when(i % 4 == 0, ".PDF").otherwise(""))
    d = table(spark, sf_dir, "documents").where("text is not null").select(path.alias("path"), content.cast("binary").alias("content")).withColumn("length", F.octet_length("content"))
    return provenance.file_secrets(d).select("key", "message")


@register("sc4_row_faults", """WITH c AS (SELECT conv_id, conv_id % 90 AS m, CASE WHEN conv_id % 13 = 0 THEN '' ELSE 'c' || CAST(conv_id % 90 AS VARCHAR) END AS id, count_if(role = 'system') AS n_system FROM {conversations} GROUP BY conv_id)
 SELECT id AS key, 'no id' AS message FROM c WHERE id = '' UNION ALL SELECT id, 'no messages' FROM c WHERE conv_id % 17 = 0 UNION ALL SELECT id, 'invalid message' FROM c WHERE conv_id % 17 <> 0 AND n_system > 0 UNION ALL SELECT id, 'repeated id' FROM c WHERE id <> '' GROUP BY id HAVING count(*) > 1""")
def row_faults(spark, sf_dir):
    i = F.col("conv_id")
    role = F.when(F.col("role") == "system", "other").otherwise(F.col("role"))
    g = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(role.alias("role"), F.coalesce("text", F.lit("")).alias("content"))).alias("messages"))
    rows = g.select(F.when(i % 13 == 0, "").otherwise(F.concat(F.lit("c"), (i % 90).cast("string"))).alias("id"), F.when(i % 17 != 0, F.col("messages")).alias("messages"))
    return sampling.row_faults(rows)


@register("va20_exact_budget", "WITH w AS (SELECT conv_id, count(*) AS n FROM {conversations} GROUP BY 1) SELECT 'budget' AS \"check\", CAST(count(*) AS VARCHAR) || ' windows' AS message FROM w UNION ALL SELECT 'budget', CAST(count_if(n <> 4) AS VARCHAR) || ' windows of another size' FROM w HAVING count_if(n <> 4) > 0")
def exact_budget(spark, sf_dir):
    w = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("turn").alias("ids"))
    return sampling.exact_budget(w, "ids", 4, -1).select("check", "message")


@register("sp9_split_keys", "SELECT c_custkey AS id, min(c_custkey) OVER (PARTITION BY c_custkey // 64) AS split_key FROM {customer}")
def split_keys(spark, sf_dir):
    k = F.col("c_custkey")
    block = lambda n: F.floor(k / n).cast("string")
    rows = table(spark, sf_dir, "customer").select("c_custkey", block(4).alias("lineage"), F.when(k % 4 != 1, block(16)).alias("family"), F.when(k % 16 != 5, block(64)).alias("patch"))
    return sampling.split_keys(rows, "c_custkey", ["lineage", "family", "patch"])


UNMET = [("boundary", "pos % 7 = 0"), ("sources", "pos % 5 = 0"), ("cutoff", "pos % 11 = 0"), ("workload", "pos % 31 = 0"), ("oracle", "pos % 6 = 3"), ("units", "pos % 13 = 0"), ("hardware", "pos % 29 = 0"), ("restoration", "pos % 8 = 0"), ("secrets", "pos % 17 = 0"), ("reasoning", "pos % 19 = 0"), ("review", "pos % 23 = 0")]


@register("sp11_eligibility", "WITH o AS (SELECT o_orderkey AS pos FROM {orders}), u AS (SELECT pos, list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in UNMET) + "], lambda x: x IS NOT NULL) AS unmet FROM o) SELECT pos, array_to_string(unmet, ' ') AS unmet FROM u WHERE len(unmet) > 0")
def eligibility(spark, sf_dir):
    p = F.col("pos")
    empty = lambda k, v="x": F.when(p % k == 0, "").otherwise(v)
    some = F.array(F.lit("x"))
    none = F.array().cast("array<string>")
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos")).withColumns({
        "boundary": empty(7), "op_family": F.lit("x"), "source_ids": some, "license_status": F.when(p % 5 != 0, "internal"), "evidence_cutoff": empty(11), "workload": empty(31), "correctness": F.when(p % 3 == 0, "not_observed").otherwise("passed"),
        "limitations": F.when(p % 2 == 0, F.array(F.lit("oracle not_observed"))).otherwise(none), "measurements": F.array(F.struct(empty(13, "ms").alias("unit"), F.lit("lower").alias("direction"))), "architectures": some, "hardware_skus": F.when(p % 29 == 0, none).otherwise(some),
        "disposition": F.when(p % 4 == 0, "rejected").otherwise("accepted"), "candidate_commit": F.lit("c"), "restoration_commit": F.when(p % 8 != 0, "r"), "secret_scan": F.when(p % 17 == 0, "failed").otherwise("passed"), "hidden_reasoning": p % 19 == 0, "review_status": empty(23),
    })
    return e.select("pos", F.array_join(sampling.unmet(e), " ").alias("unmet")).where("unmet <> ''")


@register("ag6_greatest_text", "SELECT event_type, max(strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN '+02:00' ELSE 'Z' END) AS latest FROM {events} GROUP BY 1")
def greatest_text(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("event_type", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "+02:00").otherwise("Z")).alias("at"))
    return groups.greatest_text(d, ["event_type"], "at")


@register("ag15_failures", "SELECT event_type, count_if(event_type = 'error') AS failed, count(*) AS n FROM {events} GROUP BY 1")
def failures(spark, sf_dir):
    return groups.failures(table(spark, sf_dir, "events"), ["event_type"], "event_type", "error")


@register("so5_first_few", "SELECT CAST(count(*) AS VARCHAR) || ': ' || (SELECT string_agg(d, ', ' ORDER BY d) FROM (SELECT md5(text) AS d FROM {documents} GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 10) x) AS message FROM (SELECT md5(text) FROM {documents} GROUP BY 1 HAVING count(*) > 1) y")
def first_few(spark, sf_dir):
    d = groups.duplicates(table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("digest")), "digest")
    return builder.first_few(d, "digest")


@register("sk3_conflicts", "SELECT sha256(text) AS sha256, sha256(any_value(text) || 'x') AS actual FROM {documents} WHERE doc_id % 3 = 0 AND doc_id % 5 = 0 GROUP BY 1")
def conflicts(spark, sf_dir):
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    d = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select("doc_id", sha(F.col("text")).alias("sha256"), "text")
    there = d.where("doc_id % 5 = 0").select("sha256", sha(F.concat("text", F.lit("x"))).alias("actual")).distinct()
    return tables.conflicting(d, there)


@register("tx5_reverts", "SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN md5(CAST(event_id AS VARCHAR)) || '01234567' END AS reverts FROM {events}")
def reverts(spark, sf_dir):
    i = F.col("event_id")
    body = F.when(i % 3 == 0, "This reverts nothing").otherwise(F.concat(F.lit("Why.\n\nThis reverts commit "), F.md5(i.cast("string").cast("binary")), F.lit("01234567.")))
    return table(spark, sf_dir, "events").select("event_id", patches.reverted(F.when(i % 2 == 0, 'Revert "x"').otherwise("Add x"), body).alias("reverts"))


@register("pr24_commit_times", f"WITH h AS ({HISTORY}), l AS (SELECT l_orderkey AS pos, l_linenumber AS n, md5(CAST(l_orderkey AS VARCHAR)) || substr(md5(CAST(l_orderkey + 1 AS VARCHAR)), 1, 8) AS c FROM {{lineitem}}) SELECT pos, CAST(n AS BIGINT) AS n, 't' || CAST(h.line AS VARCHAR) AS at FROM l LEFT JOIN h ON c = h.commit")
def commit_times(spark, sf_dir):
    h = relation(spark, sf_dir, HISTORY).select("commit", F.concat(F.lit("t"), F.col("line").cast("string")).alias("committed_at"))
    k = F.col("l_orderkey")
    commit = F.concat(F.md5(k.cast("string").cast("binary")), F.substring(F.md5((k + 1).cast("string").cast("binary")), 1, 8))
    l = table(spark, sf_dir, "lineitem").select(k.alias("pos"), F.col("l_linenumber").cast("long").alias("n"), commit.alias("revision"))
    return joins.commit_times(l, h, "revision").select("pos", "n", F.col("committed_at").alias("at"))


def recorded(spark, sf_dir):
    """Episodes of the ledger relation with scope, provenance, review and a preference for some."""
    p = F.col("pos")
    prefer = F.struct(F.array(F.lit("e000")).alias("chosen_event_ids"), F.lit("no").alias("rejected_response"), F.lit("vague").alias("failure_mode"))
    c = candidates(spark, sf_dir).withColumns({"architectures": F.array(F.lit("a1")), "snapshot_refs": F.array(F.concat(F.lit("raw:"), "source_id")), "source_ids": F.array("source_id"), "limitations": F.array(F.concat(F.lit("limit "), p.cast("string"))), "review_status": F.lit("reviewed"), "preference": F.when(p % 2 == 0, prefer)})
    return episodes.episodes(c, F.col("terminal_no_win"))


ORDERED = "CASE task_view " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in episodes.INSTRUCTIONS.items()) + " END"


@register("ep10_episode_preferences", CANDIDATES + EVENTS + f""" SELECT episode_id AS id, {rendered_sql('input')} AS prompt, '[instruction | evidence: ' || lref || ']' || chr(10) || {ORDERED} AS chosen, 'no' AS rejected, 'vague' AS failure_mode, ['raw:' || source_id] AS snapshot_refs
 FROM w WHERE assigned_split = 'train' AND pos % 2 = 0""")
def preferences(spark, sf_dir):
    return episodes.preferences(recorded(spark, sf_dir)).select("id", "prompt", "chosen", "rejected", "failure_mode", "snapshot_refs")


@register("ep11_evaluation_fields", CANDIDATES + EVENTS + f""" SELECT episode_id AS id, ['a1'] AS architecture_scope, {[*episodes.RUBRIC]} AS rubric, ['raw:' || source_id] AS required_snapshot_refs, md5({rendered_sql('input')}) AS prompt_md5, md5({rendered_sql('target')}) AS answer_md5
 FROM w WHERE assigned_split IN ('validation', 'test')""")
def evaluation_fields(spark, sf_dir):
    return episodes.evaluated(recorded(spark, sf_dir)).select("id", "architecture_scope", "rubric", "required_snapshot_refs", F.md5("prompt").alias("prompt_md5"), F.md5("reference_answer").alias("answer_md5"))


@register("ep12_quarantine_reasons", CANDIDATES + f" SELECT {NAME} AS id, ['limit ' || CAST(pos AS VARCHAR)] AS reason, 'reviewed' AS review_status, [source_id] AS source_ids FROM e WHERE assigned_split = 'quarantine'")
def quarantine_reasons(spark, sf_dir):
    return episodes.quarantined(recorded(spark, sf_dir)).select("id", "reason", "review_status", "source_ids")


@register("ep13_curated_manifest", CANDIDATES + " SELECT 'sft/' || assigned_split AS relative_path, count(*) AS n FROM e WHERE assigned_split <> 'quarantine' GROUP BY 1 UNION ALL SELECT 'preference/train', count(*) FROM e WHERE assigned_split = 'train' AND pos % 2 = 0 UNION ALL SELECT 'eval/' || assigned_split || '.' || s, count(*) FROM e, (VALUES ('public'), ('private')) v(s) WHERE assigned_split IN ('validation', 'test') GROUP BY 1 UNION ALL SELECT 'quarantine/index', count(*) FROM e WHERE assigned_split = 'quarantine'")
def curated(spark, sf_dir):
    return episodes.curated_manifest(recorded(spark, sf_dir)).select("relative_path", "n")
