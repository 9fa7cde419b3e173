"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from corpusloom.llm import bpe_text, collocations, jaccard, langid, lm_score, packing, quality, shards, spelling, suffix_dedup, token_counts, token_files, topk
from corpusloom.llm.tokens import vocabulary

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


@query
def op2_size_tiered_shards(spark, sf_dir):
    return shards.sharded(table(spark, sf_dir, "documents"))


@query
def op3_ngram_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1024)


@query
def op6_simple8b_token_files(spark, sf_dir):
    return token_files.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op7_distribution_divergence(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark, sf_dir):
    return token_counts.count(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op9_lattice_likelihood(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op10_bpe_segment_tree(spark, sf_dir):
    return bpe_text.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op11_phrase_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


@query
def op12_suffix_dedup(spark, sf_dir):
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op1_exact_topk"] = """WITH f AS (SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM f q JOIN f c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
 SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 20"""

#: Classes are texts with one set of shingles; links are found between classes, and components by all that links reach.
ORACLES["op3_ngram_jaccard"] = r"""WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 t AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g FROM w),
 d AS (SELECT doc_id, len(g) AS n, md5(array_to_string(g, chr(10))) AS c, g FROM t), k AS (SELECT c, any_value(g) AS g, any_value(n) AS n, min(doc_id) AS class_id FROM d WHERE n > 0 GROUP BY c),
 x AS (SELECT c, n, unnest(g) AS g FROM k), o AS (SELECT a.c AS a, b.c AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o FROM x a JOIN x b ON a.g = b.g AND a.c <> b.c GROUP BY 1, 2),
 e AS (SELECT a, b FROM o WHERE 100 * o >= 80 * (na + nb - o)), reach(c, l) AS (SELECT c, c FROM k UNION SELECT reach.c, e.b FROM reach JOIN e ON reach.l = e.a),
 m AS (SELECT reach.c, min(k.class_id) AS component_id FROM reach JOIN k ON reach.l = k.c GROUP BY 1), n AS (SELECT a AS c, count(*) AS n_links FROM e GROUP BY 1)
 SELECT doc_id, CAST(d.n AS BIGINT) AS n_shingles, CASE WHEN d.n = 0 THEN doc_id ELSE component_id END AS component_id, CASE WHEN d.n = 0 THEN doc_id ELSE class_id END AS class_id, coalesce(n_links, 0) AS n_links
 FROM d LEFT JOIN (SELECT c, class_id FROM k) kk ON d.c = kk.c AND d.n > 0 LEFT JOIN m ON d.c = m.c AND d.n > 0 LEFT JOIN n ON d.c = n.c AND d.n > 0"""

#: Phrases of up to 5 words from lists of words; a phrase is held by any longer one of which it is a slice.
ORACLES["op11_phrase_collocations"] = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
 w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p), n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
 s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), g AS (SELECT lang, unnest(list_transform(range(1, least(5, len(w) - i + 1) + 1), lambda k: w[i:i + k - 1])) AS g FROM s),
 f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 100), c AS (SELECT * FROM f WHERE len(g) > 1),
 k AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM c),
 x AS (SELECT k.lang, k.g, k.a, k.k, l.f AS l, r.f AS r, n.n, CAST((1000::HUGEINT * k.a * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.g = k.g[1:k.k] JOIN f r ON r.lang = k.lang AND r.g = k.g[k.k + 1:] JOIN n ON n.lang = k.lang),
 b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
 z AS (SELECT lang, g, f, unnest(range(2, len(g))) AS m FROM c), h AS (SELECT lang, f, m, g, unnest(range(1, len(g) - m + 2)) AS i FROM z), held AS (SELECT lang, g[i:i + m - 1] AS g, max(f) AS held FROM h GROUP BY 1, 2)
 SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.g, ' ')) AS rank, array_to_string(b.g, ' ') AS phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
 FROM b LEFT JOIN held ON held.lang = b.lang AND held.g = b.g WHERE held.held IS NULL OR 100 * held.held < 100 * a QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.g, ' ')) <= 2000"""
