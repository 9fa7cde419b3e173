"""Registration of queries, and relations of corpus shape over the driver's tables in SQL that both engines take."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def register(name: str, sql: str | None = None):
    """Add the decorated (spark, sf_dir) function under a name, with the SQL that gives the same rows."""

    def add(query):
        QUERIES[name] = query
        if sql is not None:
            for t in TABLES:
                sql_ = ORACLES.get(name, sql)
                ORACLES[name] = sql_.replace("{" + t + "}", t)
        return query

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def relation(spark, sf_dir, sql):
    """A relation below, over a folder of tables."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql})


def _case(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


COMMIT = "md5(CAST({0} AS STRING)) || substr(md5(CAST({0} + 1 AS STRING)), 1, 8)"
#: A ledger: every order is a candidate with cells as they are found in ledgers.
LEDGER = f"""SELECT o_orderkey AS pos, o_orderpriority AS campaign_id, CAST(o_custkey % 5 AS STRING) AS cycle, CAST(o_orderkey % 24 AS STRING) AS candidate,
 'run-cycle' || CAST(o_custkey % 3 AS STRING) || '-ledger' AS source_id,
 {_case("o_orderkey", ["' Accept: faster'", "'ACCEPTED'", "'reject: slower '", "' N/A '", "'Rejected'", "'open'"])} AS decision,
 {_case("o_orderkey", ["'pass'", "'Oracle FAIL at 3'", "'did not pass'", "'not-run'", "'unknown'", "'fine'", "NULL"])} AS oracle_result,
 {_case("o_custkey", ["'Fused GQA softmax'", "'SwiGLU tile'", "'q4 unpack'", "'plain loop'", "'DFlash2 sampling'", "'nvfp4 scale'"])} AS mechanism,
 {_case("o_custkey", ["'None'", "'fewer passes'", "''", "'wider loads'"])} AS hypothesis,
 {_case("o_orderkey", ["'accept: 41.2 ms'", "'n/a'", "' 42 ms '"])} AS public_op_result,
 {_case("o_orderkey", ["'Reject: worse'", "''", "NULL", "'na'"])} AS real_boundary_result,
 'Engine' AS program_boundary, CAST(o_custkey AS STRING) AS program_baseline_ms, {_case("o_custkey", ["'9.5'", "'unknown'"])} AS program_rep1_ms, {_case("o_custkey", ["'1.2'", "NULL", "''"])} AS program_rep1_delta_pct,
 {_case("o_orderkey", ["'train'", "'validation'", "'test'", "'train'", "'quarantine'"])} AS assigned_split, {_case("o_orderkey", ["'train'", "'in_arch'", "'cross_arch'"])} AS evaluation_tier,
 o_orderkey AS commit_key, o_totalprice AS total FROM {{orders}}"""
#: A history: every event is a commit; each fifth reverts the one before.
HISTORY = f"""SELECT {COMMIT.format("event_id")} AS "commit", {COMMIT.format("event_id - 1")} AS parent, event_type AS source_id, event_id AS line, user_id AS source_pos,
 CASE WHEN event_id % 5 = 0 THEN {COMMIT.format("event_id - 1")} END AS reverts_commit, CASE WHEN event_id % 5 = 0 THEN 'restoration' ELSE 'candidate_or_retained_change' END AS kind,
 'tree' || CAST(CASE WHEN event_id % 5 = 0 THEN event_id - 2 ELSE event_id END AS STRING) AS tree FROM {{events}}""".replace('"commit"', "commit")
#: A patch per part: a documentation file and a code file.
PATCH = """SELECT p_partkey AS pos, p_name AS mechanism, p_type AS files, 'diff --git a/docs/' || p_brand || '.md b/docs/' || p_brand || '.md' || chr(10) || '@@ -1 +1 @@' || chr(10) || '-old' || chr(10) || '+new' || chr(10)
 || 'diff --git a/src/' || p_brand || '.cu b/src/' || p_brand || '.cu' || chr(10) || 'index ' || md5(p_name) || chr(10) || '--- a/src/x' || chr(10) || '+++ b/src/x' || chr(10) || '@@ -' || CAST(p_size AS STRING) || ',2 +1,2 @@ f()' || chr(10)
 || '   keep_sm_86();' || chr(10) || '-  old_' || CAST(p_size AS STRING) || '();' || chr(10) || '+  new();  ' || chr(10) || ' ' || chr(125) || chr(10) AS patch FROM {part}"""
