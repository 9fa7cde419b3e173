"""Aggregates, splits, order-dependent rules and campaign analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Splits from least to most restrictive.
SPLITS = ["train", "validation", "test", "quarantine"]


def counts(df: DataFrame, singles: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """what, value, n of several groupings in one pass: by a column, or by two with the values joined by a bar."""
    sets = [(c, F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in singles]
    sets += [(f"{a}|{b}", F.concat_ws("|", F.coalesce(F.col(a).cast("string"), F.lit("")), F.coalesce(F.col(b).cast("string"), F.lit("")))) for a, b in pairs]
    each = F.array(*[F.struct(F.lit(n).alias("what"), v.alias("value")) for n, v in sets])
    keys = list(dict.fromkeys([*singles, *[x for p in pairs for x in p]]))
    # grouping by all keys first leaves little to be spread over the sets
    few = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return few.select(F.inline(each), "n").groupBy("what", "value").agg(F.sum("n").alias("n"))


def reconcile_splits(df: DataFrame, fingerprint: str, pos: str, split: str = "assigned_split", tier: str = "evaluation_tier") -> DataFrame:
    """Every row gets the most restrictive split of its fingerprint and the tier of the first row that has it.

    A grouped aggregate joined back, as a window would bring all rows of a fingerprint into one task.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col(split))
    owner = df.groupBy(fingerprint).agg(F.max_by(F.struct(F.col(split).alias("s"), F.col(tier).alias("t")), F.struct(rank, -F.col(pos), tier)).alias("o"))
    return df.drop(split, tier).join(owner, fingerprint).select(*[c for c in df.columns if c not in (split, tier)], F.col("o.s").alias(split), F.col("o.t").alias(tier))


def crossing(df: DataFrame, keys: list[str], split: str) -> DataFrame:
    """kind, key, n: keys of any kind that are in more than one split."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in keys])
    return df.select(F.inline(each), split).where("key is not null").distinct().groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def latest_time(df: DataFrame, by: str, column: str) -> DataFrame:
    """Per key the latest of timestamps with offsets, as it was written."""
    return df.where(F.col(column) != "").groupBy(by).agg(F.max_by(F.col(column), F.struct(F.to_timestamp(column), column)).alias("latest"))


def greatest_text(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Per key the greatest value as text, whatever times it may stand for."""
    return df.groupBy(*by).agg(F.max(column).alias("latest"))


def failures(df: DataFrame, by: list[str], status: str, failed: str = "failed") -> DataFrame:
    """Per key the rows that failed, and all."""
    return df.groupBy(*by).agg(F.count_if(F.col(status) == failed).alias("failed"), F.count("*").alias("n"))


def terminal(df: DataFrame, campaign: str, cycle: str, pos: str, accepted) -> DataFrame:
    """last (in ledger order) and terminal_no_win (last of a cycle without an accepted row)."""
    g = df.groupBy(campaign, cycle).agg(F.max(pos).alias("_last"), F.bool_or(accepted).alias("_any"))
    out = df.join(g, [campaign, cycle])
    return out.withColumn("last", F.col(pos) == F.col("_last")).withColumn("terminal_no_win", F.col("last") & ~F.col("_any")).drop("_last", "_any")


def collapse(df: DataFrame, fingerprint: str, pos: str, ref: str) -> DataFrame:
    """One row per fingerprint: the first, with all references sorted."""
    return df.groupBy(fingerprint).agg(F.min(pos).alias(pos), F.count("*").alias("n"), F.array_sort(F.collect_set(ref)).alias("refs"))


def capped(df: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """At most so many rows of each group, the first in order (the sampler's rule)."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_k") <= most).drop("_k")


def cycle_state(df: DataFrame, campaign: str, cycle: str, pos: str, accepted, budget: int = 24) -> DataFrame:
    """slot in the cycle, and whether the row was still allowed: within budget and not after an accepted row."""
    w = Window.partitionBy(campaign, cycle).orderBy(pos)
    before = F.coalesce(F.bool_or(accepted).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    slot = F.row_number().over(w)
    return df.withColumn("slot", slot).withColumn("allowed", (slot <= budget) & ~before)


def accept_gate(df: DataFrame, key: list[str], mode: str = "mean", min_pct: float = 1.5, min_abs: float = 3.0) -> DataFrame:
    """Per candidate of (base_ms, ms, tok_gain) repetitions: mean: the mean gain reaches min_pct, or min_abs tokens with a gain; each: every
    repetition does; all: every one reaches min_pct, two at least."""
    pct = 100 * (F.col("base_ms") - F.col("ms")) / F.col("base_ms")
    g = df.withColumn("_p", pct).groupBy(*key).agg(F.avg("_p").alias("mean_pct"), F.min("_p").alias("min_pct"), F.avg("tok_gain").alias("mean_tok"), F.min("tok_gain").alias("min_tok"), F.count("*").alias("reps"))
    p, t = ("min_pct", "min_tok") if mode in ("each", "all") else ("mean_pct", "mean_tok")
    ok = F.col(p) >= min_pct
    if mode != "all":
        ok = ok | ((F.col(t) >= min_abs) & (F.col(p) > 0))
    else:
        ok = ok & (F.col("reps") >= 2)
    return g.withColumn("accepted", ok)


def worst_points(df: DataFrame, key: list[str], point: str, base: str, value: str) -> DataFrame:
    """Per candidate the point with the largest regression in percent; points are never averaged."""
    d = 100 * (F.col(value) - F.col(base)) / F.col(base)
    return df.withColumn("_d", d).groupBy(*key).agg(F.max("_d").alias("worst_pct"), F.max_by(point, F.struct("_d", F.col(point))).alias("worst_point"))


def summary(df: DataFrame, by: list[str], speedup: str, valid, accepted, claimed) -> DataFrame:
    """Geometric mean speed-up of valid rows, the worst, and the rates of valid, accepted and falsely claimed rows."""
    s = F.when(valid & (F.col(speedup) > 0), F.col(speedup))
    rate = lambda c: F.avg(c.cast("double"))
    return df.groupBy(*by).agg(F.exp(F.avg(F.ln(s))).alias("geomean"), F.min(s).alias("worst"), rate(valid).alias("valid_rate"), rate(accepted).alias("accept_rate"), rate(claimed & ~valid).alias("false_claim_rate"), F.count_if(accepted).alias("n_accepted"))


def combo_eligible(disposition, correct, op_gain, conflict):
    """What a rejected candidate is worth to a combination."""
    return F.when(disposition != "rejected", "not rejected").when(correct != "passed", "unsound").when(conflict, "conflicting").when(op_gain > 0, "eligible").otherwise("no gain")


def lengths(df: DataFrame, by: list[str], n: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.min(n).alias("least"), F.avg(n).alias("mean"), F.percentile(n, 0.5).alias("median"), F.max(n).alias("most"))


def budget_prefix(df: DataFrame, key: str, n: str, required: int, tag: str = "nvfp4-calibration-v1") -> DataFrame:
    """Rows in the order of SHA-256(tag, NUL, key) until n adds up to required; the row that reaches it is the last. Adds start.

    Running sums go by the digest's first 12 bits: sums of those 4096 ranges are few, and the order within one is a window of
    its own.
    """
    h = F.sha2(F.concat(F.lit(tag), F.lit("\0"), F.col(key)).cast("binary"), 256)
    d = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 3))
    sums = d.groupBy("_b").agg(F.sum(n).alias("_s"))
    before = sums.select("_b", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum(n).over(Window.partitionBy("_b").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return d.join(F.broadcast(before), "_b").withColumn("start", (F.col("_before") + own).cast("long")).where(F.col("start") < required).drop("_h", "_b", "_before")


def with_starts(df: DataFrame, key: str, n: str, width: int = 4096) -> DataFrame:
    """df with start, the sum of n over all rows of smaller keys (whole numbers, each once), in three levels.

    Rows are summed by ranges of width keys, and these by ranges of width ranges; windows span one range of keys, one range of
    ranges, and what is left: a row for width * width keys.
    """
    d = df.withColumn("_b", F.floor(F.col(key) / width)).withColumn("_own", F.coalesce(F.sum(n).over(Window.partitionBy(F.floor(F.col(key) / width)).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    blocks = df.groupBy(F.floor(F.col(key) / width).alias("_b")).agg(F.sum(n).alias("_s")).withColumn("_span", F.floor(F.col("_b") / width))
    inner = blocks.withColumn("_in", F.coalesce(F.sum("_s").over(Window.partitionBy("_span").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    spans = blocks.groupBy("_span").agg(F.sum("_s").alias("_t"))
    before = spans.select("_span", F.coalesce(F.sum("_t").over(Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    at = inner.join(before, "_span").select("_b", (F.col("_in") + F.col("_before")).alias("_at"))
    return d.join(at, "_b").withColumn("start", (F.col("_own") + F.col("_at")).cast("long")).drop("_b", "_own", "_at")


def windows(df: DataFrame, ids: str, start: str, size: int, count: int) -> DataFrame:
    """window, ids: a stream of id lists with known starts, cut into count windows of size. Raises if there are too few ids."""
    s, n = F.col(start).cast("long"), F.size(ids)
    # a list goes to its windows in pieces, not id by id: an id alone takes many times its bytes in a shuffle
    last = F.least(F.expr(f"(`{start}` + size(`{ids}`) - 1) div {size}"), F.lit(count - 1)).cast("long")
    first = F.expr(f"cast(`{start}` as long) div {size}")
    each = df.where((n > 0) & (first <= last)).select(s.alias("_s"), F.col(ids).alias("_ids"), F.explode(F.sequence(first, last)).alias("window"))
    at = F.greatest(F.col("window") * size - F.col("_s"), F.lit(0)).cast("int")
    cut = each.select("window", (F.col("_s") + at).alias("at"), F.slice("_ids", at + 1, ((F.col("window") + 1) * size - F.col("_s") - at).cast("int")).alias("ids"))
    rows = cut.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("x")).select("window", F.flatten(F.transform("x", lambda e: e["ids"])).alias("x"))
    full = F.when(F.size("x") == size, F.col("x")).otherwise(F.raise_error(F.lit("too few tokens for the budget")))
    return rows.select("window", full.alias("ids"))
