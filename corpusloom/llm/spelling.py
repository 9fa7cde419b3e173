"""Spelling variants of a corpus's words by wildcard groups, without a list of pairs.

Two words differ by a replaced code point exactly where they share a group (letters before, position, letters after). A
group has at most one word for each letter of the alphabet, whatever the size of the corpus; it keeps its size and its two
most frequent words, from which each member's share follows. Two words differ by an inserted code point where one of them
with a code point left out is the other, so deletions join the vocabulary itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows

#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
#: Every so many pairs of a document and a run lose a code point.
TYPO_EVERY = 97
LETTERS, OCCURRENCES, TIMES = 5, 3, 2
#: Words that a task counts before it sends its counts on; bytes above which a text's runs are counted one by one.
FLUSH, LONG = 300_000, 1 << 20


def slip(doc_id: int | None, run: bytes, every: int = TYPO_EVERY) -> bytes:
    """The run, or where crc32 of "<doc_id>:<run>" is a multiple of every the run without its code point number crc32 % length."""
    h = zlib.crc32(run, zlib.crc32(_lead(doc_id)))
    return run if h % every else _without(run, h)


def _lead(doc_id: int | None) -> bytes:
    return b":" if doc_id is None else b"%d:" % doc_id


def _without(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def words(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, every: int = TYPO_EVERY) -> DataFrame:
    """word, n of all runs of at least so many code points and occurrences, after the slips. Null text has no runs, a null doc_id is
    empty in the text that decides on slips, repeated rows count again."""

    def run(parts):
        crc = zlib.crc32
        total: Counter = Counter()
        for part in parts:
            for doc_id, text in zip(part["doc_id"], part["_text"], strict=True):
                low = text.lower()
                found = Counter(RUN.findall(low) if len(low) < LONG else (m.group() for m in RUN.finditer(low)))
                lead = crc(_lead(doc_id))
                for w in [w for w in found if not crc(w, lead) % every]:
                    n = found.pop(w)
                    total[_without(w, crc(w, lead))] += n
                total.update(found)
                if len(total) > FLUSH:
                    yield {"word": list(total), "n": list(total.values())}
                    total.clear()
        if total:
            yield {"word": list(total), "n": list(total.values())}

    rows.prepare(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), rows.text_bytes(docs).alias("_text"))
    counted = rows.map_rows(texts, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= occurrences).select(F.col("word").cast("string").alias("word"), "n").where(F.length("word") >= letters)


def merged(words_: DataFrame) -> DataFrame:
    """A table of words for a join that sorts and merges: by its compressed file Spark would take a vocabulary for one that fits the driver."""
    return words_.hint("merge")


def _replaced(vocabulary: DataFrame) -> DataFrame:
    """word, near, best of each word in each wildcard group that has others: their number and the first of them by (-n, word)."""
    keys = F.expr("explode(transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), '*', substring(word, i + 1))))")
    member = F.struct((-F.col("n")).alias("less"), F.col("word").alias("form"))
    groups = vocabulary.select(keys.alias("key"), member.alias("member")).groupBy("key").agg(F.array_sort(F.collect_list("member")).alias("members")).where(F.size("members") > 1)
    top = groups.select((F.size("members") - 1).cast("long").alias("near"), F.col("members")[0].alias("first"), F.col("members")[1].alias("second"), F.explode("members").alias("member"))
    return top.select(F.col("member.form").alias("word"), "near", F.when(F.col("member") == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("best"))


def _inserted(vocabulary: DataFrame, letters: int) -> DataFrame:
    """word, near, best from the words that a deletion leads to, and from those that lead here by one."""
    shorter = F.expr("explode(array_distinct(transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), substring(word, i + 1)))))")
    cut = vocabulary.where(F.length("word") > letters).select(shorter.alias("short"), F.col("word").alias("long"), F.col("n").alias("n_long"))
    met = cut.join(merged(vocabulary), F.col("short") == F.col("word")).select("short", F.col("n").alias("n_short"), "long", "n_long")
    side = lambda word, form, n: met.select(F.col(word).alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col(n)).alias("less"), F.col(form).alias("form")).alias("best"))
    return side("short", "long", "n_long").unionByName(side("long", "short", "n_short"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root of forms (word, form): the last word that forms lead to. A form has at least twice its word's n, so there is no
    cycle; each round doubles the steps taken, so the rounds follow the logarithm of the longest way."""
    now = rows.settled(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), f"{folder}/roots-0")
    step = 0
    while now.where("open").limit(1).count():
        step += 1
        on = now.select(F.col("word").alias("via"), F.col("root").alias("far"))
        now = rows.settled(now.join(merged(on), F.col("root") == F.col("via"), "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("open")), f"{folder}/roots-{step}")
    return now.select("word", "root")


def variants(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n, root of each word of words(docs).

    Near words differ by one inserted, deleted or replaced code point; n_near counts them. form is the near word of largest n
    (ties: the smallest by code points) if it has times the word's n, else null with a null form_n; root follows forms to
    the last, and is the word itself without a form. An empty table, or one without such words, gives no rows. Columns other
    than doc_id and text play no part.
    """
    folder = rows.shared_dir(docs.sparkSession)
    vocabulary = rows.settled(words(docs, letters, occurrences), f"{folder}/vocabulary")
    near = _replaced(vocabulary).unionByName(_inserted(vocabulary, letters)).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    formed = vocabulary.join(merged(near), "word", "left").withColumn("formed", -F.col("best.less") >= times * F.col("n"))
    found = rows.settled(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("formed"), F.col("best.form")).alias("form"), F.when(F.col("formed"), -F.col("best.less")).alias("form_n")), f"{folder}/near")
    last = roots(found.where("form is not null"), folder)
    return found.join(merged(last), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
