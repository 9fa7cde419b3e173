"""Queries on histories that are read from exports, on fetched pages, and on near duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import ledger, payloads
from corpusloom.operators import calibration, candidates, near_duplicates, topology
from corpusloom.plans.ledger_queries import UNVERDICT, VERDICT, sql_clean
from corpusloom.plans.registry import COMMIT, HISTORY, LEDGER, register, relation, table
from corpusloom.sources import fetching, generated, git_log, keyed, tables

#: Every user's events are a line of commits; each sixth also has the commit four before as a parent, and each seventh says that it reverts: half of
#: these by name, the others by restoring the tree before their parent.
GRAPH = f"""SELECT event_id, user_id, k, {COMMIT.format('event_id')} AS c, CASE WHEN k > 1 THEN {COMMIT.format('before')} END AS p1, CASE WHEN k % 6 = 0 THEN {COMMIT.format('before4')} END AS p2, CASE WHEN k % 7 = 0 THEN {COMMIT.format('before')} END AS undone,
 CAST(CASE WHEN k % 7 = 0 THEN before2 ELSE event_id END AS STRING) AS tree, event_type, before_k FROM (SELECT event_id, user_id, event_type, row_number() OVER w AS k, lag(event_id) OVER w AS before, lag(event_id, 2) OVER w AS before2, lag(event_id, 4) OVER w AS before4, row_number() OVER w - 1 AS before_k
 FROM {{events}} WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) x"""


def exported(spark, sf_dir):
    """The relation as log exports in the shared folder."""
    g = relation(spark, sf_dir, GRAPH)
    body = F.when((F.col("k") % 14 == 0), F.concat(F.lit("\n  why\n\nThis reverts commit "), "undone", F.lit(".\n"))).otherwise(F.concat(F.lit(" about "), F.col("event_id").cast("string"), F.lit("\n\n")))
    subject = F.when(F.col("k") % 7 == 0, F.concat(F.lit("Revert "), "event_type")).otherwise(F.col("event_type"))
    patch = F.concat(F.lit("\n\ndiff --git a/x b/x\n@@ -1 +1 @@\n-H\n+"), F.col("event_id").cast("string"))
    record = git_log.log_record(F.col("c"), F.array_compact(F.array("p1", "p2")), F.col("tree"), F.concat(F.lit("2024-01-01T00:00:"), F.lpad((F.col("k") % 60).cast("string"), 2, "0"), F.lit("Z")), subject, body, patch)
    path = tables.scratch(spark, "log-export")
    g.select(record.alias("value")).write.text(path)
    return path


@register("sc6_git_history", f"""WITH g AS ({GRAPH}) SELECT c AS commit, array_to_string(list_filter([p1, p2], lambda x: x IS NOT NULL), ' ') AS parents, '2024-01-01T00:00:' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || 'Z' AS committed_at, CASE WHEN k % 7 = 0 THEN 'Revert ' ELSE '' END || event_type AS subject,
 md5(CASE WHEN k % 14 = 0 THEN 'why' || chr(10) || chr(10) || 'This reverts commit ' || undone || '.' ELSE 'about ' || CAST(event_id AS VARCHAR) END) AS body_md5, CASE WHEN k % 7 = 0 THEN 'restoration' ELSE 'candidate_or_retained_change' END AS kind,
 CASE WHEN k % 14 = 0 THEN undone WHEN k % 7 = 0 AND k % 6 <> 0 AND (k - 1) % 6 <> 0 THEN undone END AS reverts_commit, md5('diff --git a/x b/x' || chr(10) || '@@ -1 +1 @@' || chr(10) || '-H' || chr(10) || '+' || CAST(event_id AS VARCHAR) || chr(10)) AS patch_md5 FROM g""")
def git_history(spark, sf_dir):
    """Exports read in splits of 64 KiB; reverts by name, or proven by trees where the commit and its parent have one parent each."""
    d = git_log.described(git_log.git_log(spark, exported(spark, sf_dir), split=1 << 16))
    return d.select("commit", F.array_join("parents", " ").alias("parents"), "committed_at", "subject", F.md5("body").alias("body_md5"), "kind", "reverts_commit", F.md5("patch").alias("patch_md5"))


@register("so4_topological_order", f"""WITH RECURSIVE g AS ({GRAPH}), e AS (SELECT c, p1 AS p FROM g WHERE p1 IS NOT NULL UNION SELECT c, p2 FROM g WHERE p2 IS NOT NULL), r(c, l) AS (SELECT c, 0 FROM g WHERE p1 IS NULL UNION SELECT e.c, r.l + 1 FROM r JOIN e ON e.p = r.c),
 m AS (SELECT c, max(l) AS level FROM r GROUP BY c) SELECT c AS commit, CAST(level AS BIGINT) AS level, row_number() OVER (ORDER BY level, c) - 1 AS position FROM m""")
def topological_order(spark, sf_dir):
    return topology.positions(git_log.git_log(spark, exported(spark, sf_dir), ["commit", "parents"]))


#: Bytes that a page may have here.
CAP = 6000


@register("sc9_fetched_pages", f"""SELECT 'page-' || CAST(page_id AS VARCHAR) AS source_id, CASE WHEN page_id % 10 = 7 OR strlen(html) > {CAP} THEN 'failed' ELSE 'collected' END AS status, CASE WHEN page_id % 10 = 7 THEN 'ValueError: scheme ftp' WHEN strlen(html) > {CAP} THEN 'ValueError: more than {CAP} bytes' END AS reason,
 CASE WHEN page_id % 10 <> 7 AND strlen(html) <= {CAP} THEN sha256(html) END AS sha256, CASE WHEN page_id % 10 <> 7 AND strlen(html) <= {CAP} THEN strlen(html) END AS bytes, CASE WHEN page_id % 10 <> 7 AND strlen(html) <= {CAP} THEN 'text/html' END AS mime_type FROM {{pages}}""")
def fetched_pages(spark, sf_dir):
    """Every page by a URL that holds it, as there is no network here; each tenth by a scheme that isn't fetched."""
    held = F.concat(F.lit("data:text/html;charset=utf-8;base64,"), F.replace(F.base64(F.col("html").cast("binary")), F.lit("\r\n"), F.lit("")))
    d = table(spark, sf_dir, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("source_id"), F.when(F.col("page_id") % 10 == 7, "ftp://host/x").otherwise(held).alias("url"))
    return fetching.fetched(d, cap=CAP).select("source_id", "status", "reason", "sha256", "bytes", "mime_type")


#: Sets of 5-word runs, links of 80 % of the union, and what they reach.
CLUSTERS = r"""w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w FROM {documents}),
 g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g FROM w),
 k AS (SELECT md5(array_to_string(g, chr(10))) AS c, any_value(g) AS g, min(doc_id) AS least FROM g WHERE len(g) > 0 GROUP BY 1), x AS (SELECT c, len(g) AS n, unnest(g) AS g FROM k),
 o AS (SELECT a.c AS a, b.c AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o FROM x a JOIN x b ON a.g = b.g AND a.c <> b.c GROUP BY 1, 2), e AS (SELECT a, b FROM o WHERE 100 * o >= 80 * (na + nb - o)),
 r(c, l) AS (SELECT c, c FROM k UNION SELECT r.c, e.b FROM r JOIN e ON r.l = e.a), m AS (SELECT r.c, min(k.least) AS cluster FROM r JOIN k ON r.l = k.c GROUP BY 1),
 f AS (SELECT g.doc_id, coalesce(m.cluster, g.doc_id) AS cluster FROM g LEFT JOIN m ON len(g.g) > 0 AND md5(array_to_string(g.g, chr(10))) = m.c)""".replace("\\\\", "\\")


@register("tx7_clusters", f"WITH RECURSIVE {CLUSTERS} SELECT doc_id, cluster FROM f")
def near_duplicate_clusters(spark, sf_dir):
    return near_duplicates.clusters(table(spark, sf_dir, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "cluster")


@register("tx7_capped", f"WITH RECURSIVE {CLUSTERS}, s AS (SELECT d.doc_id, row_number() OVER (PARTITION BY cluster, lang ORDER BY d.doc_id) AS k FROM {{documents}} d JOIN f ON d.doc_id = f.doc_id) SELECT doc_id FROM s WHERE k <= 1")
def near_duplicates_capped(spark, sf_dir):
    """The language stands for outcome and chip."""
    return near_duplicates.capped_near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", ["lang"], 1).select("doc_id")


@register("sp8_training_sample", f"""WITH l AS (SELECT *, mechanism || hypothesis AS cluster, {VERDICT} AS d, 'g' || CAST(pos % 97 AS VARCHAR) AS grp FROM ({LEDGER}) x), t AS (SELECT *, max(pos) OVER g AS last, bool_or(d = 'accepted' AND pos % 40 = 0) OVER g AS won FROM l WHERE assigned_split = 'train' WINDOW g AS (PARTITION BY campaign_id, grp)),
 n AS (SELECT *, NOT won AND pos = last AS ends FROM t), c AS (SELECT *, row_number() OVER (PARTITION BY cluster, d, grp ORDER BY ends DESC, pos) AS k FROM n), k AS (SELECT * FROM c WHERE ends OR k <= 3), z AS (SELECT *, row_number() OVER (PARTITION BY campaign_id, grp ORDER BY ends DESC, pos) AS j FROM k)
 SELECT pos FROM z WHERE won OR j <= 8 UNION ALL SELECT pos FROM l WHERE assigned_split <> 'train'""")
def training_sample(spark, sf_dir):
    d = relation(spark, sf_dir, LEDGER)
    d = d.withColumns({"cluster": F.concat("mechanism", "hypothesis"), "outcome": ledger.disposition(F.col("decision")), "grp": F.concat(F.lit("g"), (F.col("pos") % 97).cast("string"))})
    won = (F.col("outcome") == "accepted") & (F.col("pos") % 40 == 0)
    return near_duplicates.training_sample(d, "pos", "cluster", ["outcome", "grp"], ["campaign_id", "grp"], "pos", won).select("pos")


@register("sk4_bucketed_upserts", """WITH b AS (SELECT o_custkey AS k, o_orderkey % 3 AS b, max({'o': o_orderkey, 's': o_orderstatus, 'd': CAST(o_orderdate AS VARCHAR)}) AS r FROM {orders} GROUP BY 1, 2), c AS (SELECT DISTINCT k FROM b),
 j AS (SELECT c.k, x.r AS x, y.r AS y, z.r AS z FROM c LEFT JOIN b x ON x.k = c.k AND x.b = 0 LEFT JOIN b y ON y.k = c.k AND y.b = 1 LEFT JOIN b z ON z.k = c.k AND z.b = 2),
 m AS (SELECT k, CASE WHEN y IS NULL OR (x IS NOT NULL AND x.s = y.s) THEN x ELSE y END AS m, z FROM j), n AS (SELECT k, CASE WHEN z IS NULL OR (m IS NOT NULL AND m.s = z.s) THEN m ELSE z END AS r FROM m) SELECT k, r.s AS status, r.d AS created_at, r.o AS line FROM n""")
def bucketed_upserts(spark, sf_dir):
    """Three batches of orders by customer: only another status makes a new row. Two entries a bucket, so the third batch rewrites buckets."""
    d = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("string").alias("created_at"), F.col("o_orderkey").alias("line"))
    t = keyed.KeyedTable(spark, tables.scratch(spark, "keyed"), "k", 16, 2, ("created_at", "line"))
    for n in range(3):
        t.commit(d.where(F.col("line") % 3 == n), n, "line")
    return t.read(d.schema)


#: Tokens of a calibration window, and how many windows: a third of the characters.
WINDOW = 512


@register("va20_calibration_windows", f"""WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') || chr(3) AS t FROM {{documents}}), n AS (SELECT CAST(sum(length(t)) // {3 * WINDOW} AS BIGINT) AS n FROM t), s AS (SELECT string_agg(t, '' ORDER BY sha256('{calibration.TAG}' || chr(0) || id)) AS s FROM t),
 w AS (SELECT unnest(range(0, n)) AS "window" FROM n) SELECT "window", md5(substr(s, CAST("window" * {WINDOW} + 1 AS BIGINT), {WINDOW})) AS text_md5, ascii(substr(s, CAST("window" * {WINDOW} + 1 AS BIGINT), 1)) AS first_id FROM w, s""")
def calibration_windows(spark, sf_dir):
    """A character is a token, and 3 ends a text. Only a third of the documents is tokenized."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    n = (d.agg(F.sum(F.length("text") + 1)).collect()[0][0] or 0) // (3 * WINDOW)
    made, _ = calibration.windows(d, lambda texts: [[ord(c) for c in t] for t in texts], lambda lists: ["".join(map(chr, x)) for x in lists], 3, WINDOW, n)
    return made.select("window", F.md5("text").alias("text_md5"), F.col("ids")[0].alias("first_id"))


@register("pr21_payload_text", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'said "' || event_type || '"' || chr(10) ELSE '{' || chr(10) || '  "a": [' || chr(10) || '    ' || CAST(event_id AS VARCHAR) || ',' || chr(10) || '    {' || chr(10) || '      "x": "' || event_type || '",' || chr(10) || '      "y": []' || chr(10) || '    },' || chr(10) || '    1e+16' || chr(10) || '  ],' || chr(10) || '  "b": null,' || chr(10) || '  "é": "' || event_type || ' ü\\\\ \\n",' || chr(10) || '  "ﬁ": {}' || chr(10) || '}' END AS said FROM {events}""")
def payload_texts(spark, sf_dir):
    kind = F.col("event_type")
    nested = F.concat(F.lit('{"ﬁ": {}, "é": "'), kind, F.lit(' \\u00fc\\\\ \\n", "b" : null, "a": ['), F.col("event_id").cast("string"), F.lit(', {"y": [], "x": "'), kind, F.lit('"}, 1E16]}'))
    text = F.concat(F.lit('"said \\"'), kind, F.lit('\\"\\n"'))
    return table(spark, sf_dir, "events").select("event_id", payloads.payload_text(F.when(F.col("event_id") % 5 == 0, text).otherwise(nested)).alias("said"))


@register("pr12_candidates", f"""WITH l AS ({LEDGER}), h AS (SELECT event_id FROM {{events}}), p AS (SELECT l.*, {VERDICT} AS d, {UNVERDICT.format(sql_clean('public_op_result'))} AS pc, 'c' || cycle || '_' || lpad(candidate, 2, '0') AS ord,
  CASE WHEN {sql_clean('real_boundary_result')} <> '' THEN {UNVERDICT.format(sql_clean('real_boundary_result'))} ELSE concat_ws('; ', nullif({sql_clean('program_boundary')}, ''), 'baseline ' || nullif({sql_clean('program_baseline_ms')}, '') || ' ms', 'rep1 ' || nullif({sql_clean('program_rep1_ms')}, '') || ' ms' || coalesce(' (' || nullif({sql_clean('program_rep1_delta_pct')}, '') || '% improvement)', '')) END AS pr,
  c.event_id IS NOT NULL AS known, r.event_id IS NOT NULL AND r.event_id % 5 = 0 AND pos % 2 = 0 AS undone FROM l LEFT JOIN h c ON c.event_id = pos LEFT JOIN h r ON r.event_id = pos + 1)
 SELECT pos, cycle, candidate, ord AS ordering, mechanism, {sql_clean('hypothesis')} AS hypothesis, pc AS public_candidate, pr AS program_result, d AS disposition, coalesce(nullif(pc, ''), nullif(pr, ''), {sql_clean('decision')}) AS reason,
 CASE WHEN known AND (d <> 'rejected' OR undone) THEN {COMMIT.format('pos')} END AS candidate_commit, CASE WHEN pos % 2 = 0 AND NOT (d = 'rejected' AND known AND NOT undone) THEN {COMMIT.format('pos + 1')} END AS restoration_commit,
 CAST(CASE WHEN known AND d = 'rejected' AND NOT undone THEN 1 ELSE 0 END + CASE WHEN known THEN 0 ELSE 1 END AS BIGINT) AS n_limitations, CASE WHEN cycle = '3' THEN 'validation' ELSE 'train' END AS assigned_split,
 coalesce(nullif(concat_ws('; ', 'public Op: ' || nullif(pc, ''), 'real boundary: ' || nullif(pr, '')), ''), 'No performance measurement was observed.') AS performance_claim, [source_id, 'ctx'] || CASE WHEN known OR (pos % 2 = 0 AND pos + 1 IN (SELECT event_id FROM h)) THEN ['hist'] ELSE [] END AS source_ids, source_id || '#' || trim(regexp_replace(lower(ord), '[^a-z0-9]+', '-', 'g'), '-') AS ledger_ref FROM p""")
def wide_candidates(spark, sf_dir):
    """The ledger relation under other headers; its commits are prefixes of those of the events' history."""
    l = relation(spark, sf_dir, f"SELECT *, substr({COMMIT.format('pos')}, 1, 12) AS c, CASE WHEN pos % 2 = 0 THEN {COMMIT.format('pos + 1')} END AS r FROM ({LEDGER}) l")
    rows = l.select(
        F.col("pos").alias("key"), "campaign_id", "source_id", F.col("pos").alias("line"), "cycle", "candidate", "decision", F.col("oracle_result").alias("oracle"), F.col("mechanism").alias("changed_mechanism"), F.col("hypothesis").alias("package_hypothesis"), "public_op_result",
        "real_boundary_result", "program_boundary", "program_baseline_ms", "program_rep1_ms", "program_rep1_delta_pct", F.col("c").alias("commit"), F.col("r").alias("restoration"),
    )
    names = l.select("campaign_id").distinct()
    campaigns = names.select("campaign_id", F.lit("train").alias("assigned_split"), F.lit("train").alias("evaluation_tier"), F.array(F.lit("ctx")).alias("context_source_ids"), F.lit("other").alias("default_op_family"))
    cycles = names.select("campaign_id", F.lit("3").alias("cycle"), F.lit("validation").alias("assigned_split"), F.lit("in_arch").alias("evaluation_tier"))
    history = relation(spark, sf_dir, HISTORY).select("commit", F.lit(None).cast("string").alias("patch"), "reverts_commit", F.lit("hist").alias("source_id"))
    none = spark.createDataFrame([], "campaign_id string, source_id string, source_pos int, line int, about string, in_cycle string")
    sources = l.select("source_id").distinct().unionByName(spark.createDataFrame([("ctx",), ("hist",)], "source_id string"))
    latest = sources.select("source_id", F.concat(F.lit("raw:"), "source_id").alias("record_id"), F.lit("2024-01-01T00:00:00Z").alias("created_at"))
    found = candidates.candidates(rows, campaigns, cycles, history, none, latest, spark.createDataFrame([], "source_id string, source_date string"))
    return found.select(F.col("key").alias("pos"), "cycle", "candidate", F.col("order").alias("ordering"), "mechanism", "hypothesis", "public_candidate", "program_result", "disposition", "reason", "candidate_commit", "restoration_commit", F.size("limitations").cast("long").alias("n_limitations"), "assigned_split", "performance_claim", "source_ids", "ledger_ref")


@register("sk2_changed_versions", "SELECT CAST(s AS VARCHAR) AS step, s IN (1, 3) AS wrote, CASE WHEN s = 4 THEN 2 WHEN s = 3 THEN 2 ELSE 1 END AS versions, (SELECT count(*) FROM {conversations}) AS n FROM (VALUES (1), (2), (3), (4)) v(s)")
def changed_versions(spark, sf_dir):
    """The turns, four times: new, the same from other partitions, with one turn's text changed, and the same again."""
    c = table(spark, sf_dir, "conversations")
    lines = c.select(F.format_string("%012d-%06d", "conv_id", "turn").alias("key"), tables.canonical("conv_id", "turn", "role", "text").alias("value"))
    first = lines.agg(F.min("key")).collect()[0][0]
    other = lines.withColumn("value", F.when(F.col("key") == first, "{}").otherwise(F.col("value")))
    path, out = tables.scratch(spark, "generated-turns"), []
    for step, made in enumerate((lines, lines.repartition(7), other, other), 1):
        wrote = generated.write_if_changed(made, "key", path)
        out.append((str(step), wrote, len(generated._versions(spark, path)), spark.read.text(generated.current(spark, path)).count()))
    return spark.createDataFrame(out, "step string, wrote boolean, versions int, n long")
