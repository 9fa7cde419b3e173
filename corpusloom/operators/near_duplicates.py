"""Clusters of near duplicates: min-hash bands propose most links, prefixes of the rarest shingles the others; exact similarities decide, links connect."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from corpusloom.operators.sampling import SALTS, linked_labels
from corpusloom.sources import tables

WORDS, PERCENT = 5, 80
#: At a similarity of 0.8, BANDS bands of ROWS min-hashes propose all but 1 - (1 - 0.8^4)^24 = 0.000003 of the pairs.
BANDS, ROWS = 24, 4
#: Rounds of leaders of a bucket: see links().
LEADERS = 4
#: Shingles whose min-hashes a task finds at a time.
CHUNK = 1 << 17
#: Counters of shingles, and components with a shingle that a task compares with the others of that shingle.
COUNTERS, BLOCK = 1 << 20, 1000


def shingle_sets(rows: DataFrame, id_: str, text: str, words: int = WORDS) -> DataFrame:
    """id, shingles: distinct hashes of the runs of words (the whole of a shorter text) in lower case. Null and blank texts have none: null."""
    split = F.filter(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"(?U)\s+"), lambda w: w != "")
    d = rows.select(F.col(id_).alias("id"), split.alias("_w"))
    n = F.greatest(F.size("_w") - words + 1, F.lit(1))
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice("_w", i, words)))
    return d.select("id", F.when(F.size("_w") > 0, F.array_distinct(each)).alias("shingles"))


def signed(sets: DataFrame, bands: int = BANDS, per: int = ROWS, whole: bool = False) -> DataFrame:
    """id, cls, size, buckets of sets: a 128-bit digest of each, how many shingles it has, and a bucket for each band. All but the id are null
    without shingles. Whole: the sorted shingles in place of the buckets.

    A min-hash is the least of the shingles after a multiplication and a mixing step of its own, found for many sets in one array.
    """
    kind = next(f for f in sets.schema.fields if f.name == "id")
    out = StructType([kind, StructField("cls", StringType()), StructField("size", IntegerType()), StructField("shingles" if whole else "buckets", ArrayType(LongType()))])
    names, at_once = out.fieldNames(), CHUNK

    def run(batches):
        draw = np.random.default_rng(7)
        factors, shifts = (draw.integers(1, 1 << 63, bands * per, dtype=np.uint64) for _ in range(2))
        factors, mix, by = factors | np.uint64(1), np.uint64(0x9E3779B97F4A7C15), np.uint64(32)

        def part(sorted_, starts):
            least = np.empty((len(starts), bands * per), np.uint64)
            for k in range(bands * per):
                h = (sorted_ ^ shifts[k]) * factors[k]
                h ^= h >> by
                h *= mix
                least[:, k] = np.minimum.reduceat(h, starts)
            bucket = np.zeros((len(starts), bands), np.uint64)
            for r in range(per):
                bucket = (bucket ^ (bucket >> by)) * mix + least[:, r::per]
            return (bucket ^ (bucket >> by)) * mix

        for batch in batches:
            lists = batch.column("shingles")
            flat, ends = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            there = np.flatnonzero(np.diff(ends) * lists.is_valid().to_numpy(zero_copy_only=False))
            at = 0
            if len(there) < batch.num_rows:
                empty = batch.take(pa.array(np.setdiff1d(np.arange(batch.num_rows), there)))
                none = pa.nulls(empty.num_rows)
                yield pa.RecordBatch.from_arrays([empty.column("id"), none.cast(pa.string()), none.cast(pa.int32()), none.cast(pa.list_(pa.int64()))], names=names)
            while at < len(there):
                end = max(at + 1, int(np.searchsorted(ends[there + 1], ends[there[at]] + at_once, "right")))
                own = there[at:end]
                sets_ = [np.sort(flat[ends[i] : ends[i + 1]]) for i in own]
                sizes = np.array([len(x) for x in sets_], np.int32)
                starts = np.cumsum(sizes) - sizes
                joined = np.concatenate(sets_)
                digests = [hashlib.md5(x.tobytes(), usedforsecurity=False).hexdigest() for x in sets_]
                values = joined if whole else part(joined, starts)
                offsets = np.append(starts, len(joined)) if whole else np.arange(len(own) + 1) * bands
                held = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(own)), pa.array(digests), pa.array(sizes), held], names=names)
                at = end

    return sets.mapInArrow(run, out)


def similar(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have percent of their union in common."""
    own = lambda name: classes.select(F.col("cls").alias(name), F.col("shingles").alias(f"_{name}"))
    both = pairs.join(own("a"), "a").join(own("b"), "b")
    o = F.size(F.array_intersect("_a", "_b"))
    return both.where(100 * o >= percent * (F.size("_a") + F.size("_b") - o)).select("a", "b")


def links(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = PERCENT, leaders: int = LEADERS) -> DataFrame:
    """Verified links (a < b) between classes (cls, size, buckets).

    Each bucket names two leaders, its least and its greatest class, with which the others are compared exactly, not with each other; those that
    link with neither name the next leaders, leaders times over. The number of pairs so follows the number of classes, whatever the size of a
    bucket. A link is missed where in none of the common buckets one of the two leads: crossing() finds those that others don't make up for.
    Sets (cls, shingles) are asked for those classes alone that share a bucket with another one.
    """
    folder = tables.scratch(classes.sparkSession, "near-duplicates")
    left = classes.select("cls", "size", F.posexplode("buckets").alias("band", "bucket"))
    found = None
    for step in range(leaders):
        own = F.struct(F.col("cls"), F.col("size").alias("n"))
        # a bucket may hold a large share of all classes: the leaders are joined back over salts
        lead = left.groupBy("band", "bucket").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo.cls != hi.cls")
        dealt = lead.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        beside = left.withColumn("_salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int")).join(dealt, ["band", "bucket", "_salt"]).drop("_salt")
        beside = tables.saved(beside, f"{folder}/beside-{step}")
        if not step:
            sets = tables.saved(sets_of(beside.select("cls").distinct()), f"{folder}/sets")
        able = lambda leader: (F.col("cls") != F.col(f"{leader}.cls")) & (100 * F.least("size", f"{leader}.n") >= percent * F.greatest("size", f"{leader}.n"))
        pairs = [beside.where(able(x)).select(F.least("cls", f"{x}.cls").alias("a"), F.greatest("cls", f"{x}.cls").alias("b")) for x in ("lo", "hi")]
        now = tables.saved(similar(pairs[0].unionByName(pairs[1]).distinct(), sets, percent), f"{folder}/links-{step}")
        found = now if found is None else found.unionByName(now)
        rest = beside.where((F.col("cls") != F.col("lo.cls")) & (F.col("cls") != F.col("hi.cls")))
        for x in ("lo", "hi"):
            met = now.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
            rest = rest.join(met, (F.least("cls", f"{x}.cls") == F.col("_a")) & (F.greatest("cls", f"{x}.cls") == F.col("_b")), "left_anti")
        left = tables.saved(rest.select("cls", "size", "band", "bucket"), f"{folder}/buckets-{step + 1}")
        if not left.limit(1).count():
            break
    return found.distinct()


def counted(sets: DataFrame, counters: int = COUNTERS) -> np.ndarray:
    """How many shingles have each remainder: an order by it has common shingles last, whichever rare ones share their counter."""

    def run(batches):
        counts, mask = np.zeros(counters, np.int64), np.uint64(counters - 1)
        for batch in batches:
            flat = batch.column("shingles").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            counts += np.bincount((flat & mask).view(np.int64), minlength=counters)
        k = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int32()), "n": pa.array(counts[k])})

    # not exploded: the filter that Spark infers from that would split each text once for every shingle
    found = sets.mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(counters, np.int64)
    counts[found.column("k").to_numpy()] = found.column("n").to_numpy()
    return counts


def prefixes(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """id, cls, tokens of sets with shingles: the first shingles, by count and value, of which a set that has percent in common has one among its own."""
    kind = next(f for f in sets.schema.fields if f.name == "id")
    out = StructType([kind, StructField("cls", StringType()), StructField("tokens", ArrayType(LongType()))])
    names, at_once = out.fieldNames(), CHUNK

    def run(batches):
        mask = np.uint64(len(counts) - 1)
        for batch in batches:
            lists = batch.column("shingles")
            flat, ends = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            there = np.flatnonzero(np.diff(ends) * lists.is_valid().to_numpy(zero_copy_only=False))
            at = 0
            while at < len(there):
                end = max(at + 1, int(np.searchsorted(ends[there + 1], ends[there[at]] + at_once, "right")))
                digests, tokens = [], []
                for i in there[at:end]:
                    own = np.sort(flat[ends[i] : ends[i + 1]])
                    digests.append(hashlib.md5(own.tobytes(), usedforsecurity=False).hexdigest())
                    tokens.append(own[np.argsort(counts[own & mask], kind="stable")[: len(own) + 1 - -(-percent * len(own) // 100)]])
                offsets = np.cumsum([0, *map(len, tokens)])
                held = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(tokens).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(there[at:end])), pa.array(digests), held], names=names)
                at = end

    return sets.mapInArrow(run, out)


def crossing(members: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """a, b: all pairs of classes of different components that may have percent of their union in common. Members: token, pos (from 0) of the prefix
    of each class no, its size and component comp.

    The first token that two such sets have in common lies so early in both that what follows can still suffice: in the smaller one, or in both of
    equal sizes, within an even shorter prefix. Components with a token are paired before classes are, so classes of one component never meet; the
    components of a token are dealt over tasks by blocks.
    """
    early = F.expr(f"pos <= size - ({2 * percent} * size + {99 + percent}) div {100 + percent}")
    size = F.when(early, F.col("size"))
    # most tokens are of one component: what is left of the one shuffle of all members is little
    w = Window.partitionBy("token")
    several = members.withColumns({"_lo": F.min("comp").over(w), "_hi": F.max("comp").over(w), "_any": F.max(early).over(w)}).where("_lo < _hi and _any")
    members = tables.saved(several.drop("_lo", "_hi", "_any"), f"{tables.scratch(members.sparkSession, 'crossing')}/members")
    by = members.groupBy("token", "comp").agg(F.min(size).alias("ilo"), F.max(size).alias("ihi"), F.min("size").alias("lo"), F.max("size").alias("hi"))
    many = by.groupBy("token").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    shared = by.join(many, "token")
    one = shared.where("ilo is not null").select("token", F.col("comp").alias("ca"), "ilo", "ihi", F.expr("pmod(xxhash64(comp), parts)").cast("int").alias("part"))
    other = shared.select("token", F.col("comp").alias("cb"), "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    near = one.join(other, ["token", "part"]).where(f"ca != cb and ilo <= hi and 100 * ihi >= {percent} * lo").select("token", "ca", "cb")
    own = lambda x: [F.col("comp").alias(f"c{x}"), F.col("no").alias(x), F.col("size").alias(f"n{x}"), F.col("pos").alias(f"p{x}")]
    met = near.join(members.where(early).select("token", *own("a")), ["token", "ca"]).join(members.select("token", *own("b")), ["token", "cb"])
    able = f"(na < nb or na = nb and a < b) and 100 * na >= {percent} * nb and {100 + percent} * least(na - pa, nb - pb) >= {percent} * (na + nb)"
    return met.where(able).select("a", "b").distinct()


def clusters(rows: DataFrame, id_: str, text: str, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, per: int = ROWS, leaders: int = LEADERS) -> DataFrame:
    """id, cluster: the least id that verified links reach. Rows without words are clusters of their own; equal sets are one class.

    Links that min-hashes find make components; then all pairs of different components that may be linked are compared, so no link is lost.
    Of a text its signature and a fifth of its shingles are written and shuffled; the sets of those that may have links are made again, from the text
    of a class's least id.
    """
    folder = tables.scratch(rows.sparkSession, "clusters")
    sets = tables.saved(signed(shingle_sets(rows, id_, text, words), bands, per), f"{folder}/signed")
    by_cls = sets.where("cls is not null").groupBy("cls").agg(F.first("size").alias("size"), F.first("buckets").alias("buckets"), F.min("id").alias("least"))
    classes = tables.saved(by_cls.withColumn("no", F.monotonically_increasing_id()), f"{folder}/classes")
    number = lambda x: classes.select(F.col("cls").alias(x), F.col("no").alias(f"_{x}"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        least = tables.saved(classes.select("cls", "least").join(wanted, "cls", "left_semi"), f"{folder}/wanted")
        ids = least.select(F.col("least").alias("_least")).distinct()
        own = signed(shingle_sets(rows.join(ids, F.col(id_).eqNullSafe(F.col("_least")), "left_semi"), id_, text, words), whole=True)
        # an id that isn't unique has other texts too
        return own.join(least.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))

    def joined(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        named = pairs.select("a", "b", F.concat_ws("-", "a", "b").alias("value"))
        return linked_labels(labels, named.select(F.explode(F.array("a", "b")).alias("id"), "value"))

    found = links(classes.select("cls", "size", "buckets"), sets_of, percent, leaders).join(number("a"), "a").join(number("b"), "b")
    labels = joined(classes.select(F.col("no").alias("id"), F.col("no").alias("label")), found.select(F.col("_a").alias("a"), F.col("_b").alias("b")))

    all_sets = shingle_sets(rows, id_, text, words)
    own = prefixes(all_sets, counted(all_sets), percent)
    of_cls = classes.join(labels, F.col("no") == F.col("id")).select(F.col("cls").alias("_cls"), "no", F.col("label").alias("comp"), "size", "least")
    own = own.join(of_cls, (F.col("cls") == F.col("_cls")) & F.col("id").eqNullSafe(F.col("least")))
    members = own.select("no", "comp", "size", F.posexplode("tokens").alias("pos", "token"))
    pairs = tables.saved(crossing(members, percent), f"{folder}/pairs")
    if pairs.limit(1).count():
        asked = pairs.select(F.explode(F.array("a", "b")).alias("no")).distinct()
        kept = sets_of(classes.select("cls", "no").join(asked, "no").select("cls")).join(number("cls"), "cls")
        kept = tables.saved(kept.select(F.col("_cls").alias("cls"), "shingles"), f"{folder}/sets-{percent}")
        of = lambda x: labels.select(F.col("id").alias(x), F.col("label").alias(f"_{x}"))
        more = similar(pairs, kept, percent).join(of("a"), "a").join(of("b"), "b")
        more = tables.saved(more.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), f"{folder}/more")
        if more.limit(1).count():
            ends = more.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            further = joined(ends.select("id", F.col("id").alias("label")), more).select(F.col("id").alias("_id"), F.col("label").alias("_label"))
            labels = labels.join(further, F.col("label") == F.col("_id"), "left").select("id", F.coalesce("_label", "label").alias("label"))

    by_no = classes.join(labels, F.col("no") == F.col("id")).select(F.col("cls").alias("_cls"), "label", "least")
    least = by_no.groupBy("label").agg(F.min("least").alias("cluster"))
    by_class = by_no.join(least, "label").select("_cls", "cluster")
    with_words = sets.where("cls is not null").select("id", "cls").join(by_class, F.col("cls") == F.col("_cls")).select("id", "cluster")
    return with_words.unionByName(sets.where("cls is null").select("id", F.col("id").alias("cluster")))


def first_of_each(rows: DataFrame, by: list[str], order: list, key: str, most: int) -> DataFrame:
    """At most so many rows of each group, the first in order, found in two steps so that a large group is never sorted in one task."""
    w = lambda *more: F.row_number().over(Window.partitionBy(*by, *more).orderBy(*order))
    few = rows.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS))).withColumn("_k", w("_salt")).where(F.col("_k") <= most).drop("_k", "_salt")
    return few.withColumn("_k", w()).where(F.col("_k") <= most).drop("_k")


def capped_near_duplicates(rows: DataFrame, id_: str, text: str, by: list[str], most: int = 3, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """At most so many rows, those of the least ids, of each cluster of near duplicates with equal columns by (as outcome and chip).
    A row is only left out for others that it is linked with."""
    found = clusters(rows, id_, text, words, percent).select(F.col("id").alias("_id"), F.col("cluster").alias("_cluster"))
    d = rows.join(found, F.col(id_).eqNullSafe(F.col("_id")))
    return first_of_each(d, ["_cluster", *by], [F.col(id_)], id_, most).drop("_id", "_cluster")


def training_sample(rows: DataFrame, id_: str, cluster: str, by: list[str], cycle: list[str], pos: str, accepted, split: str = "assigned_split", near: int = 3, no_win: int = 8) -> DataFrame:
    """Training rows under both caps of the sampler, and the rows of other splits whole.

    First at most near rows of each cluster and values of by, then at most no_win rows of each cycle that has no accepted row. The last row
    of such a cycle, which establishes that it ended without a win, always stays, and counts.
    """
    train = rows.where(F.col(split) == "train")
    ends = train.groupBy(*cycle).agg(F.max(F.struct(pos, id_)).alias("_end"), F.bool_or(accepted).alias("_won"))
    d = train.join(ends.select(*[F.col(c).alias(f"_{c}") for c in cycle], "_end", "_won"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cycle]).drop(*[f"_{c}" for c in cycle])
    d = d.withColumn("_last", ~F.col("_won") & (F.col("_end") == F.struct(pos, id_)))
    order = [F.desc("_last"), F.col(pos), F.col(id_)]
    # the last row of a cycle isn't to be lost to the cap on its cluster
    few = first_of_each(d.where("not _last"), [cluster, *by], order, id_, near)
    beside = d.where("_last").groupBy(cluster, *by).agg(F.count("*").alias("_held"))
    joined = few.withColumn("_k", F.row_number().over(Window.partitionBy(cluster, *by).orderBy(*order))).join(beside.select(*[F.col(c).alias(f"_of_{c}") for c in (cluster, *by)], "_held"), [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (cluster, *by)], "left")
    kept = joined.where(F.col("_k") + F.coalesce("_held", F.lit(0)) <= near).select(*d.columns).unionByName(d.where("_last"))
    sampled = kept.where("_won").unionByName(first_of_each(kept.where("not _won"), cycle, order, id_, no_win))
    return sampled.select(*rows.columns).unionByName(rows.where(~F.coalesce(F.col(split) == "train", F.lit(False))))
