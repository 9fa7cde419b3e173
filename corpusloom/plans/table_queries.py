"""Queries on scans, sinks, exports, set operations, token budgets and plain relational shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import ledger, patches
from corpusloom.operators import groups, joins
from corpusloom.plans.registry import register, table
from corpusloom.sources import tables


@register("sc2_json_lines", "SELECT conv_id, turn, role, text FROM {conversations}")
def json_lines(spark, sf_dir):
    path = tables.scratch(spark, "jsonl")
    table(spark, sf_dir, "conversations").select(tables.canonical("conv_id", "turn", "role", "text").alias("value")).write.text(path)
    return tables.json_lines(spark, path, "conv_id long, turn long, role string, text string")


@register("sc3_csv_ledger", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source FROM {documents}")
def csv_ledger(spark, sf_dir):
    path = tables.scratch(spark, "csv")
    table(spark, sf_dir, "documents").select("doc_id", "text", "source").write.option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.csv_ledger(spark, path)


@register("sc4_strict_rows", """SELECT conv_id, count(*) AS n, count_if(role NOT IN ('system', 'user', 'assistant') OR text IS NULL OR text = '') AS bad, arg_max(role, turn) = 'assistant' AS ends_well FROM {conversations} GROUP BY conv_id""")
def strict_rows(spark, sf_dir):
    bad = ~F.col("role").isin("system", "user", "assistant") | F.col("text").isNull() | (F.col("text") == "")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), (F.max_by("role", "turn") == "assistant").alias("ends_well"))


@register("sc7_pinned_digests", "SELECT page_id AS path, sha256(html || 'x') AS expected, sha256(html) AS sha256 FROM {pages} WHERE page_id % 10 = 0")
def pinned(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    found = p.select(F.col("page_id").alias("path"), digest(F.col("html")).alias("sha256"))
    want = p.select(F.col("page_id").alias("path"), digest(F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("x"))).otherwise(F.col("html"))).alias("sha256"))
    return tables.pinned(found, want)


@register("sc10_urls", r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u, 'src/' || CAST(page_id AS VARCHAR) || '/Read.ME' AS f FROM {pages}) SELECT page_id, 'https://raw.githubusercontent.com/' || trim(regexp_replace(u, '^[A-Za-z]+://[^/]+', ''), '/') || '/r' || CAST(page_id % 3 AS VARCHAR) || '/' || f AS raw, 'repo-src-' || CAST(page_id AS VARCHAR) || '-read-me' AS child FROM p""")
def urls(spark, sf_dir):
    i = F.col("page_id").cast("string")
    repo = F.concat(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/+$", ""), F.when(F.col("page_id") % 2 == 0, ".git").otherwise(""))
    path = F.concat(F.lit("src/"), i, F.lit("/Read.ME"))
    return table(spark, sf_dir, "pages").select("page_id", tables.raw_url(repo, F.concat(F.lit("r"), (F.col("page_id") % 3).cast("string")), path).alias("raw"), tables.child_id(F.lit("repo"), path).alias("child"))


@register("sc14_collected", r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS h, lower(url) AS u FROM {pages}) SELECT page_id, CASE WHEN h = '' OR h NOT IN (SELECT h FROM (SELECT h, count(*) AS n FROM p GROUP BY h) x WHERE h LIKE '%1%' OR h LIKE '%2%') THEN 'failed' WHEN u LIKE '%/3%' THEN 'failed' ELSE 'collected' END AS status FROM p""")
def collected(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("title", F.lit("page"))
    h = F.lower(F.parse_url("url", F.lit("HOST")))
    hosts = p.select(h.alias("host")).where(F.col("host").contains("1") | F.col("host").contains("2"))
    return tables.collected(p, hosts, ["/3"]).select("page_id", "status")


@register("sk1_canonical_json", """SELECT '{{"event_type":"' || event_type || '","id":' || CAST(event_id AS VARCHAR) || ',"none":null,"user":' || CAST(user_id AS VARCHAR) || '}}' AS line FROM {events}""".replace("{{", "{").replace("}}", "}"))
def canonical(spark, sf_dir):
    d = table(spark, sf_dir, "events")
    return d.select(tables.canonical(F.col("user_id").alias("user"), F.col("event_id").alias("id"), F.lit(None).cast("string").alias("none"), "event_type").alias("line"))


@register("sk3_new_objects", "SELECT sha256(text) AS sha256, min(length(text)) AS n FROM {documents} WHERE sha256(text) NOT IN (SELECT sha256(text) FROM {documents} WHERE doc_id % 3 = 0) GROUP BY 1")
def new_objects(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.length("text").cast("long").alias("n"))
    return tables.new_objects(d, d.where("doc_id % 3 = 0")).select("sha256", "n")


@register("sk4_upsert", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 4 = 0 THEN o_orderstatus || '!' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 4 = 0 THEN 'later' ELSE 'first' END AS created_at FROM {orders} WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 0""")
def upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    old = o.where("id % 3 <> 0 or id % 4 = 0").where("not (id % 3 = 0)").withColumn("created_at", F.lit("first"))
    new = o.where("id % 2 = 0 and (id % 3 <> 0 or id % 4 = 0)").select("id", F.when(F.col("id") % 4 == 0, F.concat("status", F.lit("!"))).otherwise(F.col("status")).alias("status"), F.lit("later").alias("created_at"))
    return tables.upsert(old, new, "id")


@register("sk5_manifest", "SELECT 'raw:s' || CAST(page_id AS VARCHAR) || ':' || substr(sha256(html), 1, 16) AS record_id, sha256(html) AS sha256, CAST(octet_length(encode(html)) AS BIGINT) AS bytes, 'text/html' AS mime_type FROM {pages}")
def manifest(spark, sf_dir):
    d = table(spark, sf_dir, "pages").select(F.concat(F.lit("p/"), F.col("page_id").cast("string"), F.lit(".HTML")).alias("relative_path"), F.col("html").cast("binary").alias("content"), F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("source_id"), F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("inputs"), F.lit("2026-01-01T00:00:00Z").alias("created_at"))
    return tables.manifest_rows(d, "raw", "corpusloom").select("record_id", "sha256", "bytes", "mime_type")


@register("pr17_endings", r"""WITH u AS (SELECT page_id, url || CASE WHEN page_id % 2 = 0 THEN '' ELSE '&z=1' END AS url, CASE page_id % 5 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/pdf' END AS m FROM {pages}), w AS (SELECT page_id, m, CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '[?#].*$', '') || '/Paper.TXT?q=a.zip' ELSE url END AS url FROM u)
 SELECT page_id, CASE m WHEN 'text/html' THEN '.html' WHEN 'application/pdf' THEN '.pdf' ELSE coalesce(nullif(lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/]+/.*(\.[A-Za-z0-9]+)$', 1)), ''), '.bin') END AS e FROM w""".replace("\\\\", "\\"))
def endings(spark, sf_dir):
    i = F.col("page_id")
    url = F.concat("url", F.when(i % 2 == 0, "").otherwise("&z=1"))
    url = F.when(i % 3 == 0, F.concat(F.regexp_replace(url, "[?#].*$", ""), F.lit("/Paper.TXT?q=a.zip"))).otherwise(url)
    mime = F.when(i % 5 == 0, "text/html").when(i % 5 == 1, "application/pdf").otherwise("x/y")
    return table(spark, sf_dir, "pages").select("page_id", ledger.ending(mime, url).alias("e"))


@register("pr19_latest_refs", "SELECT c_custkey AS key, ['raw-' || CAST(c_nationkey AS VARCHAR), 'n' || CAST(c_nationkey AS VARCHAR) || 'r'] AS refs FROM {customer}")
def latest_refs(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.array(F.concat(F.lit("raw-"), F.col("c_nationkey").cast("string")), F.concat(F.lit("latest:"), F.col("c_nationkey").cast("string"))).alias("refs"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("source_id"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("r")).alias("record_id"))
    return joins.with_latest(c, n)


@register("jn12_missing_keys", "SELECT DISTINCT CAST(l_partkey AS BIGINT) AS ref FROM {lineitem} WHERE l_partkey NOT IN (SELECT p_partkey FROM {part} WHERE p_size > 5)")
def missing_keys(spark, sf_dir):
    child = table(spark, sf_dir, "lineitem").select(F.array("l_partkey").alias("refs"))
    return joins.missing_keys(child, "refs", table(spark, sf_dir, "part").where("p_size > 5"), "p_partkey")


@register("jn13_differing", """WITH a AS (SELECT doc_id AS k, source AS s FROM {documents} WHERE doc_id % 5 <> 0), b AS (SELECT doc_id AS k, CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE source END AS s FROM {documents} WHERE doc_id % 4 <> 0) SELECT coalesce(a.k, b.k) AS key, CASE WHEN b.k IS NULL THEN 'left only' WHEN a.k IS NULL THEN 'right only' ELSE 'other value' END AS what FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.s <> b.s""")
def differing(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.col("source").alias("s"))
    return joins.differing(d.where("k % 5 <> 0"), d.where("k % 4 <> 0").withColumn("s", F.when(F.col("k") % 7 == 0, "other").otherwise(F.col("s"))), "k")


@register("st_set_algebra", "SELECT c_nationkey AS k, list_sort(list(DISTINCT c_mktsegment)) AS segments, count(DISTINCT c_mktsegment) = 5 AS every_one, list_has_any(list(DISTINCT c_mktsegment), ['BUILDING', 'NONE']) AS has_any FROM {customer} GROUP BY 1")
def set_algebra(spark, sf_dir):
    g = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.array_sort(F.collect_set("c_mktsegment")).alias("segments"))
    return g.select("k", "segments", (F.size("segments") == 5).alias("every_one"), F.arrays_overlap("segments", F.array(F.lit("BUILDING"), F.lit("NONE"))).alias("has_any"))


@register("st1_bag_union", "SELECT kind, count(*) AS n FROM (SELECT 'seed' AS kind FROM {documents} UNION ALL SELECT 'made' FROM {conversations}) x GROUP BY kind")
def bag_union(spark, sf_dir):
    one = lambda t, k: table(spark, sf_dir, t).select(F.lit(k).alias("kind"))
    return one("documents", "seed").unionByName(one("conversations", "made")).groupBy("kind").agg(F.count("*").alias("n"))


@register("st5_key_sets", "SELECT 'common' AS what, count(*) AS n FROM (SELECT doc_id FROM {documents} INTERSECT SELECT doc_id FROM {labels}) x UNION ALL SELECT 'unlabelled', count(*) FROM (SELECT doc_id FROM {documents} EXCEPT SELECT doc_id FROM {labels}) y")
def key_sets(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    both = lambda df, n: df.agg(F.count("*").alias("n")).select(F.lit(n).alias("what"), "n")
    return both(d.intersect(l), "common").unionByName(both(d.subtract(l), "unlabelled"))


@register("so2_hash_order", "SELECT doc_id, row_number() OVER (ORDER BY sha256('nvfp4-calibration-v1' || chr(0) || CAST(doc_id AS VARCHAR))) AS place FROM (SELECT DISTINCT doc_id FROM {labels}) l")
def hash_order(spark, sf_dir):
    d = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("k")).distinct().withColumn("n", F.lit(1))
    every = groups.budget_prefix(d, "k", "n", 1 << 62)
    return every.select(F.col("k").cast("long").alias("doc_id"), (F.col("start") + 1).alias("place"))


BUDGET = """WITH t AS (SELECT doc_id, n_chars AS n, sha256('nvfp4-calibration-v1' || chr(0) || CAST(doc_id AS VARCHAR)) AS h FROM {documents}), s AS (SELECT *, coalesce(sum(n) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, (SELECT sum(n) FROM t) AS total FROM t)"""


@register("wn5_budget_prefix", BUDGET + " SELECT doc_id, CAST(start AS BIGINT) AS start FROM s WHERE start < total // 3")
def budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("k"), F.col("n_chars").alias("n"))
    required = (d.agg(F.sum("n")).collect()[0][0] or 0) // 3
    return groups.budget_prefix(d, "k", "n", required).select(F.col("k").cast("long").alias("doc_id"), "start")


@register("wn6_windows", """WITH t AS (SELECT conv_id * 1000 + turn AS id, conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS spot, count(*) OVER () AS n FROM {conversations}) SELECT spot // 16 AS "window", list(id ORDER BY spot) AS ids FROM t WHERE spot < (n // 16) * 16 GROUP BY 1""")
def windows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    per = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.col("conv_id") * 1000 + F.col("turn"))).alias("ids"), F.count("*").alias("n"))
    placed = groups.with_starts(per, "conv_id", "n").select("ids", "start")
    return groups.windows(placed, "ids", "start", 16, c.count() // 16)


@register("sp7_lengths", "SELECT lang, count(*) AS rows, min(n_chars) AS least, round(avg(n_chars), 6) AS mean, quantile_cont(n_chars, 0.5) AS median, max(n_chars) AS most FROM {documents} GROUP BY lang")
def lengths(spark, sf_dir):
    return groups.lengths(table(spark, sf_dir, "documents"), ["lang"], "n_chars").withColumn("mean", F.round("mean", 6))


@register("ep9_conversation_export", """SELECT conv_id AS id, string_agg('[' || role || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS prompt, count(*) AS n FROM {conversations} GROUP BY conv_id HAVING arg_max(role, turn) = 'assistant'""")
def conversation_export(spark, sf_dir):
    g = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    g = g.where(F.element_at("m", -1)["role"] == "assistant")
    return g.select("id", F.array_join(F.transform("m", lambda x: F.concat(F.lit("["), x["role"], F.lit("]\n"), x["text"])), "\n\n").alias("prompt"), F.size("m").cast("long").alias("n"))


@register("ep10_preference_export", """SELECT c.conv_id AS id, p.text AS prompt, c.text AS chosen, 'copy of the prompt' AS failure_mode FROM {conversations} c JOIN {conversations} p ON c.conv_id = p.conv_id AND c.turn = p.turn + 1 WHERE c.role = 'assistant' AND p.role = 'user' AND c.text <> p.text""")
def preference_export(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    g = c.groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    pairs = F.zip_with(F.slice("m", 1, F.size("m") - 1), F.slice("m", 2, F.size("m")), lambda a, b: F.struct(a["role"].alias("r"), a["text"].alias("prompt"), b["role"].alias("s"), b["text"].alias("chosen")))
    return g.where(F.size("m") > 1).select("id", F.inline(pairs)).where("r = 'user' and s = 'assistant' and prompt <> chosen").select("id", "prompt", "chosen", F.lit("copy of the prompt").alias("failure_mode"))


@register("tx6_text_fingerprint", r"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '/(?:tmp|home|root|var)/[^\s]*', '<path>', 'g'), '[ \t]+', ' ', 'g'), chr(32) || chr(10) || chr(9))) AS fp FROM {documents}")
def text_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", patches.text_fingerprint(F.col("text")).alias("fp"))


@register("sk8_report", """SELECT '{"documents":' || CAST((SELECT count(*) FROM {documents}) AS VARCHAR) || ',"status":"pass"}' AS report""")
def report(spark, sf_dir):
    return tables.report(table(spark, sf_dir, "documents").agg(F.count("*").alias("documents")).withColumn("status", F.lit("pass")))


@register("wn7_row_numbers", "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS \"index\" FROM {events}")
def row_numbers(spark, sf_dir):
    return tables.numbered(table(spark, sf_dir, "events"), ["event_id"], ["event_type", "user_id"]).select("event_type", "event_id", F.col("index").cast("long").alias("index"))
