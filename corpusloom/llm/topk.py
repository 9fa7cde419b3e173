"""Exact top-k search by inner product with a three-phase uniform threshold.

Components are cut into SLICES lists of partial scores. (1) Each block of candidates gives the best of its lists, resolved
exactly, and these are merged to a k-th score that is safe. (2) That score, over the number of lists, is the cutoff that goes
back with each query. (3) A block collects the entries that reach the cutoff in any list (an entry below it in all lists
can't reach the k-th score), resolves their remaining partial scores and gives its k best, which are merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows

SLICES = 4
QUERY_BLOCK, ROW_BLOCK = 1024, 8192
#: Queries that are scored at once in a task.
AT_ONCE = 128
#: Lists that are merged into one at a time.
MERGE = 32
#: Components and scores beyond these are taken as these, so that no finite vector ends a search.
MOST, MOST_SCORE = 1 << 62, (1 << 63) - 1
LISTS = "query long, query_id long, block int, top array<struct<neg: long, vec_id: long>>"


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding", scale: int = 64) -> DataFrame:
    """row, vec_id, v: floor(scale * x) of each component (MOST at most) of each row. Vectors that are null or hold null or
    non-finite components are left out, as are null ids; rows of one id stay apart. Number the rows once: save the result."""
    x = F.transform(vectors[column], lambda e: e.cast("double"))
    fine = vectors[column].isNotNull() & vectors[vec_id].isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = F.transform(x, lambda e: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), e * scale))).cast("long"))
    return vectors.where(fine).select(F.monotonically_increasing_id().alias("row"), vectors[vec_id].cast("long").alias("vec_id"), v.alias("v"))


def _packed(df: DataFrame, blocks: int, extra: str | None = None) -> DataFrame:
    """One row per block and vector length: row numbers, ids, values and (for queries) cutoffs as bytes."""

    def packed(block, held):
        for dims, found in held.items():
            row, ids, values, cuts = zip(*found, strict=True)
            cut = np.array([np.iinfo(np.int64).min if c is None else c for c in cuts], np.int64)
            yield {"block": [block], "dims": [dims], "own": [np.array(row, np.int64).tobytes()], "ids": [np.array(ids, np.int64).tobytes()], "values": [b"".join(values)], "cuts": [cut.tobytes()]}

    def run(parts):
        now, held = None, {}  # one block's rows, by length
        for part in parts:
            for i, block in enumerate(part["block"]):
                if block != now:
                    yield from packed(now, held)
                    now, held = block, {}
                v = np.array(part["v"][i], np.int64)
                held.setdefault(len(v), []).append((part["row"][i], part["vec_id"][i], v.tobytes(), part[extra][i] if extra else None))
        yield from packed(now, held)

    dealt = df.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).repartition("block").sortWithinPartitions("block")
    return rows.map_rows(dealt, run, "block int, dims int, own binary, ids binary, values binary, cuts binary")


def _paired(queries: DataFrame, candidates: DataFrame, n_queries: int, n_rows: int) -> DataFrame:
    """Each block of queries beside each block of candidates, by an equi-join on both numbers."""
    q = queries.select(F.col("block").alias("qb"), "dims", F.col("own").alias("q_own"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), "cuts", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("block"))
    c = candidates.select("block", "dims", "own", "ids", "values", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("qb"))
    return q.join(c, ["qb", "block", "dims"])


def _kind(q: np.ndarray, c: np.ndarray):
    """A type in which inner products are exact."""
    top = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64 if top < 1 << 63 else object


def search_block(q: np.ndarray, q_own: np.ndarray, c: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, cuts: np.ndarray | None) -> list[list[tuple[int, int]]]:
    """For each query up to k pairs (-score, vec_id) of other rows, best first: phase 1 without cuts, phase 3 with them."""
    kind = _kind(q, c)
    bounds = np.linspace(0, q.shape[1], min(SLICES, max(1, q.shape[1])) + 1).astype(int)
    qs, ct = q.astype(kind), np.ascontiguousarray(c.astype(kind).T)
    order = np.argsort(ids, kind="stable")
    rank_of = np.empty(len(ids), np.int64)
    rank_of[order] = np.arange(len(ids))
    lists = len(bounds) - 1
    out = []
    for at in range(0, len(q), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        partial = [qs[some, a:b] @ ct[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        if kind is object:  # scores that may not fit a long: all of them
            which = np.broadcast_to(np.arange(len(ids)), (partial[0].shape[0], len(ids)))
        elif cuts is None:
            if len(ids) > k:
                places = np.concatenate([np.argpartition(-p, k, axis=1)[:, : k + 1] for p in partial], 1)
            else:
                places = np.broadcast_to(np.arange(len(ids)), (partial[0].shape[0], len(ids)))
            which = [np.unique(x) for x in places]
        else:
            # an integer score s over the lists reaches t = cut / lists in one of them, or is below the cut
            t = np.ceil(cuts[some] / lists) if lists else cuts[some]
            t = np.where(cuts[some] == np.iinfo(np.int64).min, -np.inf, t)[:, None]
            mask = partial[0] >= t
            for p in partial[1:]:
                mask |= p >= t
            which = [np.flatnonzero(m) for m in mask]
        for i, w in enumerate(which):
            w = w[own[w] != q_own[at + i]]
            if kind is object:
                s = np.array([max(-MOST_SCORE, min(MOST_SCORE, int(x))) for x in sum(p[i, w] for p in partial)], np.int64)
            else:
                s = np.zeros(len(w), np.int64)
                for p in partial:
                    s += p[i, w].astype(np.int64)
            if cuts is not None:
                reach = s >= cuts[at + i]
                w, s = w[reach], s[reach]
            if len(w) > k:
                best = np.lexsort((rank_of[w], -s))[:k]
                w, s = w[best], s[best]
            out.append(sorted(zip((-s).tolist(), ids[w].tolist(), strict=True)))
    return out


def _lists(pairs: DataFrame, k: int, cut: bool) -> DataFrame:
    def run(parts):
        for part in parts:
            for b, dims, qo, qi, qv, cuts, own, ids, values in zip(*(part[x] for x in ("block", "dims", "q_own", "q_ids", "q_values", "cuts", "own", "ids", "values")), strict=True):
                q_own, q_ids, own, ids = (np.frombuffer(x, np.int64) for x in (qo, qi, own, ids))
                q, c = np.frombuffer(qv, np.int64).reshape(-1, dims), np.frombuffer(values, np.int64).reshape(-1, dims)
                found = search_block(q, q_own, c, ids, own, k, np.frombuffer(cuts, np.int64) if cut else None)
                yield {"query": q_own.tolist(), "query_id": q_ids.tolist(), "block": [b] * len(q_ids), "top": [[{"neg": n, "vec_id": v} for n, v in f] for f in found]}

    return rows.map_rows(pairs, run, LISTS)


def _merged(lists: DataFrame, k: int, blocks: int) -> DataFrame:
    """The k best of all lists of a query, MERGE lists at a time, so that no group grows with the table."""
    while True:
        blocks = -(-blocks // MERGE)
        lists = lists.groupBy("query", F.expr(f"cast(block div {MERGE} as int)").alias("block")).agg(F.first("query_id").alias("query_id"), F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        if blocks <= 1:
            return lists


def search(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by every, the k highest integer inner products with the others.

    Null ids, and vectors that are null or hold null or non-finite components, take no part. Rows of one vec_id are each a query and a
    candidate; only the query's own row is left out. Components beyond 2^62 after scaling count as 2^62, and scores that don't
    fit a long as the nearest long. Ties go to the smaller vec_id. Only vectors of the query's length are compared. Fewer than k: all. An empty table, or
    no query: no rows.
    """
    spark = rows.prepare(vectors.sparkSession)
    folder = rows.shared_dir(spark)
    v = rows.saved(whole_numbers(vectors, vec_id, column), f"{folder}/vectors")
    q = v.where(F.col("vec_id") % every == 0)
    n, n_q = v.count(), q.count()
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-n_q // QUERY_BLOCK))
    candidates = rows.saved(_packed(v, row_blocks), f"{folder}/rows")
    first = _merged(_lists(_paired(_packed(q, query_blocks), candidates, query_blocks, row_blocks), k, False), k, row_blocks)
    cuts = first.select(F.col("query").alias("row"), F.when(F.size("top") >= k, -F.get("top", F.lit(k - 1))["neg"]).alias("cut"))
    second = _packed(q.join(cuts, "row", "left"), query_blocks, "cut")
    best = _merged(_lists(_paired(second, candidates, query_blocks, row_blocks), k, True), k, row_blocks)
    return best.select("query_id", F.posexplode("top").alias("p", "t")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.neg")).alias("score"))
