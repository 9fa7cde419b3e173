"""Language-model scores of whole texts: marginal probability over subword lattices, beside a count-based base score.

The pieces are those of an existing vocabulary; their probabilities come from all training words by expectation
maximisation. Counts of words stay distributed; only words with at least 1/HEAVY of all training tokens, of which there are
HEAVY at most, go to every worker, so that a very common word isn't dealt to one task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import chunks, rows
from corpusloom.llm.lattice import Lattice, existing_pieces

HEAVY = 50_000
ROUNDS = 3
#: Added to a piece's expected uses, so that every byte keeps a probability.
SMOOTHING = 0.01
#: Words whose lattices are worked on at once.
AT_ONCE = 100_000
#: Words that a task counts before it sends its counts on.
FLUSH = 300_000
#: The end of a text among the words, none of which is empty.
END = b""


def held_out(docs: DataFrame, parts: int = 7, at: int = 2):
    """Whether crc32 of doc_id as text leaves the remainder; false for a null doc_id."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % parts == at, F.lit(False))


def count_words(docs: DataFrame) -> DataFrame:
    """word binary, c long over all rows: words in lower ASCII case, and END once for each row."""

    def run(parts):
        from collections import Counter

        c: Counter = Counter()
        for part in parts:
            for text in part["_text"]:
                c.update(text.lower().split())
            c[END] += len(part["_text"])
            if len(c) > FLUSH:
                yield {"word": list(c), "c": list(c.values())}
                c.clear()
        if c:
            yield {"word": list(c), "c": list(c.values())}

    parts = rows.map_rows(docs.select(rows.text_bytes(docs).alias("_text")), run, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def fit_pieces(words: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> np.ndarray:
    """Natural log probability of each piece of the vocabulary and, last, of the end. Each round is one pass over all words."""
    n = len(existing_pieces(vocabulary))
    ends = words.where(F.length("word") == 0).agg(F.sum("c")).collect()[0][0] or 0
    log_p = None
    words = words.where(F.length("word") > 0)
    for _ in range(rounds):

        def run(parts, log_p=log_p):
            from corpusloom.llm import lm_score

            lattice = lm_score.lattice_of(vocabulary, log_p[:-1] if log_p is not None else None)
            total = np.zeros(n)
            for part in rows.gathered(parts, AT_ONCE):
                total += lattice.expected(part["word"], np.array(part["c"]))
            used = np.flatnonzero(total)
            yield {"piece": used.tolist(), "e": total[used].tolist()}

        # one number for each piece of the vocabulary
        sums = rows.map_rows(words, run, "piece int, e double").groupBy("piece").agg(F.sum("e").alias("e")).collect()
        e = np.full(n + 1, SMOOTHING)
        for r in sums:
            e[r["piece"]] += r["e"]
        e[n] += ends
        log_p = np.log(e / e.sum())
    return log_p


def lattice_of(vocabulary: str, log_p: np.ndarray | None) -> Lattice:
    """A worker's lattice over the vocabulary, with these probabilities."""
    lattice = rows.kept(("lattice", vocabulary), lambda: Lattice(existing_pieces(vocabulary)))
    lattice.log_p = np.full(len(lattice.pieces), -math.log(len(lattice.pieces))) if log_p is None else log_p
    return lattice


def score(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    Null text is empty: its only token is the end. Without training rows N and V are 0, so each token's base probability is
    1, and all pieces are alike. Repeated rows give (and count as) repeated rows; null doc_id is a training row.
    """
    spark = rows.prepare(docs.sparkSession)
    folder = rows.shared_dir(spark)
    marked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs).alias("held_out"), docs["text"])
    counts = rows.saved(count_words(marked.where(~F.col("held_out"))), f"{folder}/counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).collect()[0]
    log_p = fit_pieces(counts, vocabulary)
    floor = n + v + 1
    # at most HEAVY words, as each has 1/HEAVY of the tokens
    heavy = {bytes(r["word"]): r["c"] for r in counts.where(F.col("c") * HEAVY >= n).collect()} if n else {}
    shared = spark.sparkContext.broadcast((heavy, log_p))
    kind = np.dtype([("s", "f8"), ("b", "f8"), ("h", "i8")])

    def run(parts):
        import xxhash

        from corpusloom.llm import lm_score

        heavy, log_p = shared.value
        lattice = lm_score.lattice_of(vocabulary, log_p[:-1])

        def learn(words):
            out = np.empty(len(words), kind)
            out["s"] = lattice.log_probs(words) / math.log(10)
            out["b"] = [math.log10((heavy[w] + 1) / floor) if w in heavy else np.nan for w in words]
            out["h"] = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)
            raw = out.tobytes()
            return [raw[i : i + kind.itemsize] for i in range(0, len(raw), kind.itemsize)]

        if lattice.scored != folder:
            lattice.scored, lattice.memo = folder, chunks.Memo(learn)
        memo, at = lattice.memo, TaskContext.get().partitionId() << 40
        end_score, end_base = float(log_p[-1]) / math.log(10), heavy.get(END)
        end_hash = np.array([xxhash.xxh64_intdigest(END, 42)], np.uint64).view(np.int64)
        for part in parts:
            values, index, bounds = memo.numbered(chunks.white_split([t.lower() for t in part["_text"]]))
            all_words = np.frombuffer(b"".join(values), kind)[index]
            out = {k: [] for k in ("at", "n_tokens", "known", "base", "score")}
            hashes, times, sizes = [], [], [0]
            for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                found = all_words[a:b]
                found = found[found["h"] != end_hash[0]]  # beside white space at a text's ends there is an empty stretch
                rare = np.isnan(found["b"])
                h = found["h"][rare]
                h, c = np.unique(h if end_base is not None else np.concatenate([h, end_hash]), return_counts=True)
                hashes.append(h)
                times.append(c)
                sizes.append(len(h))
                out["at"].append(at)
                at += 1
                out["n_tokens"].append(len(found) + 1)
                out["known"].append(int(len(found) - rare.sum()) + (end_base is not None))
                out["base"].append(float(found["b"][~rare].sum()) + (math.log10((end_base + 1) / floor) if end_base is not None else 0.0))
                out["score"].append(float(found["s"].sum()) + end_score)
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(hashes)), pa.array(np.concatenate(times).astype(np.int32))], ["h", "n"])
            yield out | {"doc_id": part["doc_id"], "held_out": part["held_out"], "rare": pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pairs)}

    schema = "at long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<struct<h: long, n: int>>"
    texts = marked.select("doc_id", "held_out", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("_text"))
    scored = rows.saved(rows.map_rows(texts, run, schema), f"{folder}/scored")
    rare = scored.select("at", F.inline("rare"))
    table = counts.where(F.col("c") * HEAVY < n).select(F.xxhash64("word").alias("h"), "c") if n else counts.select(F.xxhash64("word").alias("h"), "c")
    found = rare.join(table, "h", "left").groupBy("at").agg(
        F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(floor)))).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("also"),
    )
    return scored.drop("rare").join(found, "at", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )
