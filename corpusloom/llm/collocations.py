"""Collocations from suffix arrays over word ids, built shard by shard and merged by their first words.

A shard is up to SHARD words of one language from one task, with a dictionary of its own. Words that are rarer than the threshold in
all shards end a run, as no frequent phrase holds them; the others get a number that is one for all shards. Prefix doubling ranks a shard's
suffixes by their first 1, 2, 4 and 5 words; neighbours in the suffix array that agree in k ranks have k words in common. Each
different suffix, cut after 5 words or where its run ends, leaves its shard once, with its count, in a block of the suffixes whose first two words have one
hash modulo the number of ranges. A range thus has all occurrences of its phrases: sorted, it gives exact counts of 2 to 5 words, and
only those that reach the threshold leave it. What is shuffled follows the words, whatever share of their phrases is frequent.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import chunks, rows

WORDS, LEAST, FIRST, PERCENT = 5, 100, 2000, 100
#: Words of a shard: its arrays take about 100 bytes a word.
SHARD = 1_000_000
#: Words of a range, on average. A pair of which both words occur HOT times is dealt out by its third word, and counted apart.
RANGE, HOT = 2_000_000, 500_000
#: Buckets of words, in each of which they are numbered.
BUCKETS = 4096
#: Bytes above which a text is cut.
LONG = 1 << 22
#: Characters that end a piece become STOP, which no word is; BEYOND is none either. A tab becomes a space.
ENDS, STOP, BEYOND = b".,;:!?\n\x0b\x0c\r", b".", b","
TABLE = bytes.maketrans(ENDS + b"\t", STOP * len(ENDS) + b" ")
UNKNOWN = "und"


def ranks(ids: np.ndarray, words: int = WORDS) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... ids and, last, by their first words ids, each from the one before: two
    widths side by side, or overlapping for the last. What lies beyond the end is less than all ids."""
    found, width = {1: ids.astype(np.int64)}, 1
    while width < words:
        step = min(width, words - width)
        r = found[width]
        key = r * (int(r.max(initial=0)) + 2)
        key[: max(0, len(r) - step)] += r[step:] + 1
        width += step
        found[width] = np.unique(key, return_inverse=True)[1]
    return found


def intervals(ids: np.ndarray, valid: np.ndarray, least: int, most: int, whole: bool = False):
    """k, places, counts for each k from least to most: where each phrase of k ids stands, and how often it occurs.

    valid: how many ids a phrase from each position may have; whole: only phrases of all these ids (of most, where there are more). Neighbours in the suffix array have k ids in common where their
    ranks by a power of two agree at their starts and so that the second ends with the k-th id.
    """
    r = ranks(ids, most)
    order = np.argsort(r[most], kind="stable")
    for k in range(least, most + 1):
        at = order[valid[order] == k if whole and k < most else valid[order] >= k]
        if not len(at):
            if whole:
                continue
            return
        width = max(w for w in r if w <= k)
        new = r[width][at[1:]] != r[width][at[:-1]]
        if width < k:
            new |= r[width][at[1:] + (k - width)] != r[width][at[:-1] + (k - width)]
        first = np.flatnonzero(np.concatenate([[True], new]))
        yield k, at[first], np.diff(np.append(first, len(at)))


def room(going_on: np.ndarray) -> np.ndarray:
    """For each position the length of the run of true values that starts there."""
    n = len(going_on)
    ends = np.append(np.flatnonzero(~going_on), n)
    return ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)


def suffixes(signed: np.ndarray, ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different suffixes of two and more words as rows of words ids (0 after their end), and how often each occurs.

    signed: a shard's numbers of words, ids: what each stands for in all shards (0: a word that ends a run), by that number."""
    own = ids[np.abs(signed)]
    valid = np.where(signed > 0, room(own > 0), 0)
    rows_, counts_ = [np.empty((0, words), np.int32)], [np.empty(0, np.int64)]
    for k, at, n in intervals(own, valid, 2, words, whole=True):
        part = np.zeros((len(at), words), np.int32)
        for i in range(k):
            part[:, i] = own[at + i]
        rows_.append(part)
        counts_.append(n)
    return np.concatenate(rows_), np.concatenate(counts_)


def _range(first: np.ndarray, parts: int) -> np.ndarray:
    """The range, below parts, of each row of ids."""
    h = np.zeros(len(first), np.uint64)
    for column in first.T:
        h = (h + column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(parts)).astype(np.int64)


def dealt(found: np.ndarray, n: np.ndarray, hot: np.ndarray, parts: int):
    """range, suffixes, counts for each of parts ranges that has any.

    hot: sorted ids of very common words. A suffix that begins with two of them goes by three words, with its count below 0, which doesn't count for its
    pair; the pair's count goes by the pair."""
    to = _range(found[:, :2], parts)
    if found.shape[1] > 2 and len(hot):
        both = np.isin(found[:, 0], hot) & np.isin(found[:, 1], hot)
        pairs, which = np.unique(found[both, :2], axis=0, return_inverse=True)
        apart = np.zeros((len(pairs), found.shape[1]), np.int32)
        apart[:, :2] = pairs
        longer = both & (found[:, 2] > 0)
        to[longer] = _range(found[longer, :3], parts)
        kept = ~both | longer
        pair_n = np.bincount(which.ravel(), n[both], len(pairs)).astype(np.int64)
        found, n, to = np.concatenate([found[kept], apart]), np.concatenate([np.where(longer, -n, n)[kept], pair_n]), np.concatenate([to[kept], _range(pairs, parts)])
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(ends)).tolist():
        at = order[ends[part] : ends[part + 1]]
        yield part, found[at], n[at]


def packed(found: np.ndarray, n: np.ndarray) -> bytes:
    """Suffixes and counts as compressed planes of bytes; the first words as differences, and the second ones below one first."""
    columns = np.concatenate([found.T, n[None]]).astype(np.uint32)
    first, second = columns[0].copy(), columns[1].copy()
    columns[0, 1:] -= first[:-1]
    columns[1, 1:] -= np.where(first[1:] == first[:-1], second[:-1], 0).astype(np.uint32)
    return pa.compress(np.ascontiguousarray(columns[:, :, None].view(np.uint8).transpose(0, 2, 1)), codec="zstd", asbytes=True)


def unpacked(block: bytes, rows_: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """What packed() had: columns of ids, and counts."""
    size = 4 * rows_ * (words + 1)
    planes = np.frombuffer(pa.decompress(block, size, codec="zstd", asbytes=True), np.uint8).reshape(words + 1, 4, rows_)
    columns = np.array(planes.transpose(0, 2, 1), order="C").view(np.uint32)[:, :, 0]
    start = np.flatnonzero(np.append(True, columns[0, 1:] != 0))
    columns[0] = np.cumsum(columns[0], dtype=np.uint32)
    so_far = np.cumsum(columns[1], dtype=np.uint32)
    before = so_far[start] - columns[1, start]
    columns[1] = so_far - np.repeat(before, np.diff(np.append(start, rows_)))
    return columns[:words].view(np.int32), columns[words].view(np.int32).astype(np.int64)


def frequent(columns: np.ndarray, n: np.ndarray, least: int):
    """k, rows of k ids, counts of the phrases that occur least times or more in a range."""
    keys: list = []
    bits = 64
    for c in columns:
        more = max(1, int(c.max(initial=0)).bit_length())
        if bits + more > 63:
            keys.append(c.astype(np.int64))
            bits = more
        else:
            keys[-1] = keys[-1] << more | c
            bits += more
    order = np.lexsort(keys[::-1])
    columns, n = columns[:, order], n[order]
    new = np.append(True, columns[0, 1:] != columns[0, :-1])
    for k in range(2, len(columns) + 1):
        c = columns[k - 1]
        new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        f = np.add.reduceat(np.maximum(n, 0) if k == 2 else np.abs(n), first)
        often = (f >= least) & (c[first] > 0)
        yield k, columns[:k, first[often]].T, f[often]


def _shards(docs: DataFrame, size: int, words: int) -> DataFrame:
    """shard, lang, words (distinct, sorted), uses (their counts) and ids (compressed numbers of words from 1; 0 where a piece ends, negative where a
    word only ends phrases that start before it)."""

    def run(parts):
        made = TaskContext.get().partitionId() << 32
        held: dict = {}

        def shard(lang, texts):
            nonlocal made
            found = chunks.white_split([b" ".join(texts)]).flatten().dictionary_encode()
            known = found.dictionary.view(pa.binary())
            order = pc.sort_indices(known).to_numpy()
            names = known.take(pa.array(order)).to_pylist()
            code = np.empty(len(names), np.int64)  # of words from 1, STOP 0, BEYOND -1, the stretch beside white space -2
            code[order] = np.cumsum([w not in (b"", STOP, BEYOND) for w in names])
            for i, w in enumerate(names):
                if w in (b"", STOP, BEYOND):
                    code[order[i]] = {STOP: 0, BEYOND: -1, b"": -2}[w]
            ids = code[found.indices.to_numpy()]
            ids = ids[ids > -2]
            mark = np.maximum.accumulate(np.where(ids <= 0, np.arange(len(ids)), 0))
            tail = (ids[mark] == -1) & (ids > 0)
            ids = np.where(tail, -ids, ids)[ids != -1].astype("<i4")
            names = [w for w in names if w not in (b"", STOP, BEYOND)]
            if names:
                made += 1
                yield {"shard": [made], "lang": [lang], "words": [names], "uses": [np.bincount(ids[ids > 0], minlength=len(names) + 1)[1:].tolist()], "ids": [zlib.compress(ids.tobytes(), 1)]}

        for part in parts:
            for lang, text in zip(part["lang"], part["_text"], strict=True):
                for piece in _pieces(text, words):
                    texts, n = held.get(lang, ([], 0))
                    texts += [piece, STOP]
                    held[lang] = (texts, n + len(piece))
                    if held[lang][1] > 6 * size:
                        yield from shard(lang, held.pop(lang)[0])
            while sum(n for _, n in held.values()) > 12 * size:  # many languages: the largest goes
                lang = max(held, key=lambda x: held[x][1])
                yield from shard(lang, held.pop(lang)[0])
        for lang, (texts, _) in held.items():
            yield from shard(lang, texts)

    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(UNKNOWN)).alias("lang"), rows.text_bytes(docs).alias("_text"))
    return rows.map_rows(texts, run, "shard long, lang string, words array<binary>, uses array<long>, ids binary")


def _pieces(text: bytes, words: int, size: int | None = None):
    """A text with STOP where a piece ends. A very long one is cut at a blank: after BEYOND, up to words - 1 words of the next part
    follow, for the phrases that lie across the cut."""
    size = size or LONG
    text = text.lower().translate(TABLE)
    at = 0
    while len(text) - at > size and (cut := text.find(b" ", at + size)) >= 0:
        end = cut
        for _ in range(words):  # blanks may follow each other: then fewer words, and more are looked for
            if (end := text.find(b" ", end + 1)) < 0:
                end = len(text)
                break
        while end < len(text) and len(text[cut:end].split()) < words:
            end = e if (e := text.find(b" ", end + 1)) >= 0 else len(text)
        follow = text[cut:end].split(STOP)[0].split()[: words - 1]
        yield text[at:cut].replace(STOP, b" . ") + b" " + BEYOND + b" " + b" ".join(follow)
        at = cut
    yield text[at:].replace(STOP, b" . ")


def counts(docs: DataFrame, folder: str, words: int = WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f of all phrases of 1 to words words with f >= least; lang, n of all words)."""
    shards = rows.settled(_shards(docs, SHARD, words), f"{folder}/shards")
    totals = rows.saved(shards.groupBy("lang").agg(F.sum(F.expr("aggregate(uses, 0L, (a, x) -> a + x)")).alias("n")), f"{folder}/totals")

    # a row for each shard that has the word; one exchange gives sums, numbers, and the way back to the shards
    listed = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "uses")).alias("pos", "w")).select("shard", "lang", "pos", F.col("w.words").alias("phrase"), F.col("w.uses").cast("int").alias("uses"))
    listed = listed.withColumn("bucket", F.pmod(F.hash("lang", "phrase"), F.lit(BUCKETS))).repartition("bucket")
    known = listed.withColumn("f", F.sum("uses").over(Window.partitionBy("bucket", "lang", "phrase"))).where(F.col("f") >= least)
    known = known.withColumn("id", F.dense_rank().over(Window.partitionBy("bucket").orderBy("lang", "phrase")) * BUCKETS + F.col("bucket")).select("shard", "lang", "pos", "phrase", "f", "id")
    known = rows.settled(known, f"{folder}/words")
    single = known.groupBy("lang", "id").agg(F.first("phrase").alias("phrase"), F.first("f").alias("f"))
    # a place in the shard's dictionary, an id and whether the word is very common, in one number
    code = F.shiftleft(F.col("pos").cast("long"), 33) + F.col("id").cast("long") * 2 + (F.col("f") >= HOT).cast("long")
    alive = known.groupBy("shard").agg(F.collect_list(code).alias("known"))

    def blocks(parts):
        for part in parts:
            for lang, ids, own, n in zip(part["lang"], part["ids"], part["known"], part["n"], strict=True):
                signed = np.frombuffer(zlib.decompress(ids), "<i4")
                own = np.sort(np.array(own, np.int64))
                at, number = (own >> 33) + 1, own >> 1 & 0xFFFFFFFF
                table = np.zeros(max(int(np.abs(signed).max(initial=0)), int(at[-1])) + 1, np.int64)
                table[at] = number
                hot = np.sort(number[own & 1 == 1])
                for part_of, found, times in dealt(*suffixes(signed, table, words), hot, -(-n // RANGE)):
                    yield {"lang": [lang], "range": [part_of], "m": [len(times)], "block": [packed(found, times)]}

    def phrases(parts):
        held: list = []

        def found(lang):
            columns, n = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
            held.clear()
            for k, ids, f in frequent(columns, n, least):
                for at in range(0, len(f), 50_000):
                    m = len(f[at : at + 50_000])
                    yield {"lang": [lang] * m, "k": pa.array(np.full(m, k, np.int32)), "ids": ids[at : at + m].tolist(), "f": pa.array(f[at : at + m])}

        last = None
        for part in parts:
            for lang, at, m, block in zip(part["lang"], part["range"], part["m"], part["block"], strict=True):
                if held and last != (lang, at):
                    yield from found(last[0])
                last = (lang, at)
                held.append(unpacked(block, m, words))
        if held:
            yield from found(last[0])

    # merged at any size: else the lists may be sent whole to all tasks, of which Spark doesn't know the length
    of_words = shards.select("shard", "lang", "ids").join(alive.hint("merge"), "shard").join(F.broadcast(totals) if _few(totals) else totals, "lang")
    dealt_out = rows.map_rows(of_words, blocks, "lang string, range int, m int, block binary").repartition("lang", "range").sortWithinPartitions("lang", "range")
    several = rows.saved(rows.map_rows(dealt_out, phrases, "lang string, k int, ids array<int>, f long"), f"{folder}/several")
    named = several.select("*", F.posexplode("ids").alias("i", "id")).join(single.select("lang", "id", "phrase"), ["lang", "id"]).groupBy("lang", "k", "ids", "f").agg(F.sort_array(F.collect_list(F.struct("i", "phrase"))).alias("w"))
    every = single.select("lang", F.lit(1).alias("k"), F.col("phrase").cast("string").alias("phrase"), "f").unionByName(named.select("lang", "k", F.expr("concat_ws(' ', transform(w, x -> cast(x.phrase as string)))").alias("phrase"), "f"))
    return rows.settled(every, f"{folder}/phrases"), totals


def scored(f: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, n, low (score, cut, l, r of the lowest cut) of the phrases of two and more words."""
    candidates = f.where("k > 1")
    cut = candidates.select("lang", "k", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.withColumn("head", F.expr("substring_index(phrase, ' ', cut)")).withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    heads, tails = f.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), f.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    parts = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(F.broadcast(totals) if _few(totals) else totals, "lang")
    score = F.expr("cast((cast(1000 as decimal(4, 0)) * (cast(a as decimal(16, 0)) * cast(n as decimal(16, 0)))) div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0))) as bigint)")
    return parts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))


def mine(docs: DataFrame, words: int = WORDS, least: int = LEAST, first: int = FIRST, percent: int = PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases.

    Null text is empty, null lang is UNKNOWN; repeated rows count again; a language without such phrases has no rows, nor has an
    empty table. The score is that of the lowest cut (ties: after the fewest words), floor(1000 * a * n / (l * r)) in decimals of
    38 digits, exact up to 10^16 words. A phrase goes where any longer one holds it in percent of its occurrences: then one with one more word
    does, as it occurs at least as often, so only those are looked at. Columns other than lang and text play no part.
    """
    spark = rows.prepare(docs.sparkSession)
    folder = rows.shared_dir(spark)
    f, totals = counts(docs, folder, words, least)
    candidates = f.where("k > 1")
    longer = candidates.where("k > 2").select("lang", F.expr("explode(array(substring_index(phrase, ' ', k - 1), substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)))").alias("phrase"), F.col("f").alias("held")).groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    own = scored(f, totals).join(longer, ["lang", "phrase"], "left").where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))).select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # a language is ranked in 64 parts first, so that the last window has 64 * first rows of it at most
    near = own.withColumn("_r", F.row_number().over(Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(64))).orderBy(*order))).where(F.col("_r") <= first).drop("_r")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _few(totals: DataFrame, most: int = 1000) -> bool:
    """Whether the languages are few enough to go to every task."""
    return totals.limit(most + 1).count() <= most
