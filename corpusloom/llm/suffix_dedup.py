"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of LENGTH bytes covers it that also starts earlier: in a document with a smaller doc_id, or earlier in the
same document. Each window of LENGTH bytes has an anchor, the stretch of GRAM bytes in it whose hash is least, so equal windows
have equal anchors at the same place. Anchors that occur once are counted out. What surrounds the others is dealt out by anchor,
so that equal windows meet; there a suffix array of a bounded block of text, built bucket by bucket with a difference cover
(suffix_blocks), finds the windows that stand earlier too; of equal whole stretches only the first is sorted. Anchors only choose what is sorted: whether windows are equal is
decided by their bytes. A stretch that a task has sent already for an earlier place is not sent again but removed there. The
windows of an anchor that has HOT occurrences or more are dealt out one by one, by all of their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows
from corpusloom.llm.suffix_blocks import Block, words_at

LENGTH = 100
#: Bytes of an anchor.
GRAM = 32
#: Bytes whose windows are looked at together, and bytes of text of a block that is sorted.
PART, BLOCK = 2 << 20, 4 << 20
#: Occurrences from which an anchor's windows are dealt out one by one.
HOT = 8192
#: Stretches that a task remembers to have sent.
SENT = 400_000
LAST = (1 << 63) - 1
_LOW = np.uint64((1 << 24) - 1)


def _mixed(w: np.ndarray, at: np.ndarray | slice, odd: int) -> np.ndarray:
    """A hash of the GRAM bytes from places on."""
    h = None
    for i in range(0, GRAM, 8):
        x = w[i : len(w) - GRAM + 8 + i][at] * np.uint64((0x9E3779B97F4A7C15 * (2 * i + odd)) % (1 << 64))
        h = x if h is None else (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + x
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH):
    """(piece, anchor's place, its hash, first and last window) of each run of windows with one anchor, within the pieces of a text of less than 2^24 bytes."""
    n = len(text)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, none, none
    w = words_at(text)
    key = (_mixed(w, slice(None), 1) & ~_LOW) | np.arange(n - GRAM + 1, dtype=np.uint64)  # ties: the first
    count, width = length - GRAM + 1, 1
    low = key
    while 2 * width <= count:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    if count > width:
        low = np.minimum(low[: len(low) - (count - width)], low[count - width :])
    at = (low & _LOW).astype(np.int64)
    windows = ends - starts - length + 1
    has = windows > 0
    of = np.repeat(np.flatnonzero(has), windows[has])
    if not len(of):
        return none, none, none, none, none
    before = np.cumsum(windows[has]) - windows[has]
    p = np.arange(len(of)) + np.repeat(starts[has] - before, windows[has])
    a = at[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    place = a[first]
    return of[first], place, _mixed(w, place, 3).view(np.int64), p[first], p[last]


def _parts(part: dict, length: int):
    """(text, row, offset and bounds in the text of each piece): rows' texts together; a long text in pieces that share length - 1 bytes."""
    held, size = [], 0
    for i, text in enumerate(part["_text"]):
        for at in range(0, max(1, len(text) - length + 1), PART):
            piece = text[at : at + PART + length - 1] if len(text) > PART else text
            if held and size + len(piece) > 2 * PART:
                yield _joined(held)
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        yield _joined(held)


def _joined(held):
    row, offset, pieces = zip(*held, strict=True)
    ends = np.cumsum([len(x) for x in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    return np.frombuffer(b"".join(pieces), np.uint8), np.array(row), np.array(offset), starts, ends


def _placed(docs: DataFrame) -> DataFrame:
    """doc (LAST for a null id), h (of the text), ref (of both) and _text as bytes."""
    d = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("doc"), rows.text_bytes(docs).alias("_text"))
    return d.withColumn("h", F.xxhash64("_text")).withColumn("ref", F.xxhash64("doc", "h"))


def _occurrences(placed: DataFrame, length: int) -> DataFrame:
    """ref, key, n: how often a document has an anchor."""

    def run(parts):
        for part in parts:
            ref = np.array(part["ref"], np.int64)
            for text, row, _, starts, ends in _parts(part, length):
                piece, _, key, _, _ = anchors(text, starts, ends, length)
                order = np.lexsort((key, row[piece]))
                r, k = row[piece][order], key[order]
                first = np.flatnonzero(np.concatenate([np.ones(min(1, len(r)), bool), (r[1:] != r[:-1]) | (k[1:] != k[:-1])]))
                yield {"ref": pa.array(ref[r[first]]), "key": pa.array(k[first]), "n": pa.array(np.diff(np.append(first, len(r))).astype(np.int32))}

    return rows.map_rows(placed.where(F.octet_length("_text") >= length).select("ref", "_text"), run, "ref long, key long, n int")


SENT_ROWS = "key long, doc long, h long, start long, size int, context binary"


def _stretches(alive: DataFrame, length: int) -> DataFrame:
    """Runs of size windows from start on whose anchor recurs, with their bytes and the key by which equal windows meet. Without
    bytes: runs that stand earlier in another place that this task has sent."""

    def run(parts):
        import xxhash

        sent: dict = {}
        for part in parts:
            for text, row, offset, starts, ends in _parts(part, length):
                piece, _, key, p, q = anchors(text, starts, ends, length)
                raw, out = text.tobytes(), {c: [] for c in ("key", "doc", "h", "start", "size", "context")}
                cuts = np.searchsorted(piece, np.arange(len(starts) + 1))
                for j, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)):
                    if a == b:
                        continue
                    i = int(row[j])
                    doc, h, shift = part["doc"][i], part["h"][i], int(offset[j]) - int(starts[j])
                    known, hot = np.isin(key[a:b], np.array(part["keys"][i], np.int64)), np.isin(key[a:b], np.array(part["hot"][i] or [], np.int64))
                    found = [(k, x, y) for k, x, y in zip(key[a:b][known].tolist(), p[a:b][known].tolist(), q[a:b][known].tolist(), strict=True)]
                    for x, y in zip(p[a:b][hot].tolist(), q[a:b][hot].tolist(), strict=True):
                        found += [(xxhash.xxh64_intdigest(raw[z : z + length]) - (1 << 63), z, z) for z in range(x, y + 1)]
                    for k, x, y in found:
                        context = raw[x : y + length]
                        name = xxhash.xxh3_128_digest(context)
                        place = (doc, h, x + shift)
                        if (before := sent.get(name)) is None or place <= before:
                            sent[name] = place
                        else:
                            context = None
                        for c, v in zip(out, (k, *place, y - x + 1, context), strict=True):
                            out[c].append(v)
                yield out
                if len(sent) > SENT:
                    sent.clear()

    return rows.map_rows(alive.select("doc", "h", "_text", "keys", "hot"), run, SENT_ROWS)


def _later(stretches: DataFrame, length: int) -> DataFrame:
    """doc, h, start, size of the runs of windows that stand earlier too."""

    def solve(held):
        found = Block(b"".join([x[4] for x in held]), length)
        at = np.cumsum([0, *[len(x[4]) for x in held]])
        sizes = np.array([x[3] for x in held])
        of = np.repeat(np.arange(len(held)), sizes)
        places = np.arange(len(of)) + np.repeat(at[:-1] - (np.cumsum(sizes) - sizes), sizes)
        again = found.repeats(places)
        if not len(again):
            return
        of = np.searchsorted(at, again, side="right") - 1
        new = np.flatnonzero(np.concatenate([[True], (again[1:] != again[:-1] + 1) | (of[1:] != of[:-1])]))
        size = np.diff(np.append(new, len(again)))
        out = {"doc": [], "h": [], "start": [], "size": size.tolist()}
        for i, a in zip(of[new].tolist(), again[new].tolist(), strict=True):
            out["doc"].append(held[i][0])
            out["h"].append(held[i][1])
            out["start"].append(held[i][2] + a - int(at[i]))
        yield out

    def run(parts):
        held, n, group, last, key, seen = [], 0, 0, None, None, set()  # rows of a block; its bytes; where the last key's rows begin
        for part in parts:
            out = {c: [] for c in ("doc", "h", "start", "size")}
            for k, *row in zip(*(part[c] for c in ("key", "doc", "h", "start", "size", "context")), strict=True):
                if k != key:
                    if len(held) - group == 1:
                        n -= len(held.pop()[4])  # nothing to meet
                    if n > BLOCK:
                        yield from solve(held)
                        held, n = [], 0
                    key, group, last, seen = k, len(held), None, set()
                if tuple(row[:3]) == last:
                    continue  # a repeated row is the same document
                last = tuple(row[:3])
                if row[4] in seen:  # all of it stands earlier, as an equal stretch
                    for c, v in zip(out, row, strict=False):
                        out[c].append(v)
                    continue
                seen.add(row[4])
                held.append(row)
                n += len(row[4])
            if out["doc"]:
                yield out
        if len(held) - group == 1:
            held.pop()
        if held:
            yield from solve(held)

    dealt = stretches.repartition("key").sortWithinPartitions("key", "doc", "h", "start")
    return rows.map_rows(dealt, run, "doc long, h long, start long, size int")


def _kept(marked: DataFrame, length: int) -> DataFrame:
    """doc_id and the figures of what is left of each text, from the runs of windows that go."""

    def run(parts):
        for part in parts:
            out: dict = {"doc_id": part["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for text, starts, sizes in zip(part["_text"], part["starts"], part["sizes"], strict=True):
                spans = removed(np.array(starts or [], np.int64), np.array(sizes or [], np.int64), length)
                sha, at = hashlib.sha256(), 0
                for a, b in spans:
                    sha.update(text[at:a])
                    at = b
                sha.update(text[at:])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(sha.hexdigest())
            yield out

    return rows.map_rows(marked, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def removed(starts: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal spans that runs of windows cover."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate((starts + sizes + length - 1)[order])
    new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
    return list(zip(a[new].tolist(), b[np.append(new[1:], len(a)) - 1].tolist(), strict=True))


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, h (hash of the text), starts, sizes: the runs of windows of each document that stand earlier too."""
    spark = rows.prepare(docs.sparkSession)
    folder = rows.shared_dir(spark)
    placed = _placed(docs)
    counted = _occurrences(placed, length).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key", (F.col("n") >= HOT).alias("often"))
    recurring = rows.settled(counted, f"{folder}/recurring")
    split = [F.collect_list(F.when(F.col("often") == often, F.col("key"))).alias(name) for often, name in ((False, "keys"), (True, "hot"))]
    alive = rows.settled(_occurrences(placed, length).join(recurring, "key").groupBy("ref").agg(*split), f"{folder}/alive")
    sent = rows.settled(_stretches(placed.join(alive, "ref"), length), f"{folder}/stretches")
    found = sent.where("context is null").select("doc", "h", "start", "size").unionByName(_later(sent.where("context is not null"), length))
    return rows.settled(found.groupBy("doc", "h").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes")), f"{folder}/spans")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row.

    Null and empty texts have 0 bytes and lose none. A null doc_id comes after all others. Rows of one doc_id with one text are one
    document, given as often; of one doc_id with several texts, the text with the smaller 64-bit hash is the earlier one. An
    empty table gives no rows. Columns other than doc_id and text play no part.
    """
    gone = spans(docs, length).withColumnsRenamed({"doc": "_doc", "h": "_h"})
    placed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), rows.text_bytes(docs).alias("_text")).withColumns({"doc": F.coalesce("doc_id", F.lit(LAST)), "h": F.xxhash64("_text")})
    marked = placed.join(gone, (F.col("doc") == F.col("_doc")) & (F.col("h") == F.col("_h")), "left")
    return _kept(marked.select("doc_id", "_text", "starts", "sizes"), length)
