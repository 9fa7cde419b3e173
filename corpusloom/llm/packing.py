"""Packing of documents' tokens into sequences of one length: best fit, then swaps between underfull sequences.

Pieces are packed in groups of about GROUP, each in one task, so nothing grows with the table; a group leaves at most a
few sequences underfull. The swaps exchange one piece for one, two for one, or move one, while that increases the sum of
squared fills; emptied sequences go.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows, tokens

END = 2
GROUP = 32_768
#: Rounds of swaps over all underfull sequences; each needs an improvement to go on.
ROUNDS = 20
#: Pieces of a sequence that are looked at in pairs.
PAIRED = 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, at long"


def pieces(docs: DataFrame, vocabulary: str, size: int, kind=tokens.ByteIds, end: int = END) -> DataFrame:
    """One row per piece: whole documents (with the end id) up to size tokens; longer ones cut so that all but the first have size."""
    end_bytes = np.array([end], "<u4").tobytes()

    def run(parts):
        ids_of = tokens.shared(kind, vocabulary)
        at = TaskContext.get().partitionId() << 40
        for part in parts:
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "at")}
            for doc, ids in zip(part["doc_id"], ids_of.ids(part["_text"]), strict=True):
                raw = memoryview(ids + end_bytes)
                n = len(raw) // 4
                a, piece = 0, 0
                while a < n:
                    b = a + ((n - a) % size or size)
                    for k, v in zip(out, (doc, piece, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), at), strict=True):
                        out[k].append(v)
                    a, piece, at = b, piece + 1, at + 1
            yield out

    rows.prepare(docs.sparkSession)
    return rows.map_rows(docs.select(docs["doc_id"].cast("long").alias("doc_id"), rows.text_bytes(docs).alias("_text")), run, PIECES)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Longest first into the fullest bin that has room."""
    open_bins: dict[int, list[int]] = defaultdict(list)
    mask, bins = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                mask &= ~(1 << room)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > n:
            open_bins[room - n].append(b)
            mask |= 1 << (room - n)
    return bins


class _Rooms:
    """Underfull bins by their room, and there by the lengths (of one piece, or of two) that they could give back."""

    def __init__(self, bins: list[list[int]], lengths: list[int], size: int):
        self.bins, self.lengths, self.size = bins, lengths, size
        #: room -> (length -> bins), and the lengths as bits of one number; apart for one piece and for two.
        self.held: tuple[dict, dict] = ({}, {})
        self.bits: tuple[dict, dict] = ({}, {})
        self.open: dict[int, set[int]] = {}

    def room(self, b: int) -> int:
        return self.size - sum(self.lengths[i] for i in self.bins[b])

    def _sums(self, b: int) -> tuple[set, set]:
        found = [self.lengths[i] for i in self.bins[b]]
        # of a bin of many pieces, those in front: a search, not the result, is made shorter
        return set(found), {x + y for k, x in enumerate(found[:PAIRED]) for y in found[:k]}

    def add(self, b: int) -> None:
        room = self.room(b)
        if not 0 < room < self.size:
            return
        self.open.setdefault(room, set()).add(b)
        for held, bits, sums in zip(self.held, self.bits, self._sums(b), strict=True):
            here = held.setdefault(room, {})
            for n in sums:
                here.setdefault(n, set()).add(b)
                bits[room] = bits.get(room, 0) | 1 << n

    def remove(self, b: int) -> None:
        room = self.room(b)
        if b not in self.open.get(room, ()):
            return
        self.open[room].discard(b)
        if not self.open[room]:
            del self.open[room]
        for held, bits, sums in zip(self.held, self.bits, self._sums(b), strict=True):
            here = held[room]
            for n in sums:
                here[n].discard(b)
                if not here[n]:
                    del here[n]
                    bits[room] &= ~(1 << n)

    def best(self, sent: dict[int, tuple], most: int) -> tuple[int, tuple, int, int] | None:
        """(rise, what is sent, the bin, the length it gives back or 0) with the highest rise of the squared fill (half of it) for a
        bin whose room is at most `most`, the room of the bin that sends. A bin of room r that gains g raises it by g * (most - r + g)."""
        best, found = 0, None
        rooms = sorted(r for r in self.open if r <= most)
        for n in sorted(sent, reverse=True):
            who = sent[n]
            at = bisect_left(rooms, n)
            if at < len(rooms) and n * (most - rooms[at] + n) > best:  # of the rooms that take it whole the smallest
                best, found = n * (most - rooms[at] + n), (n, who, rooms[at], 0)
            for r in reversed(rooms[:at]):
                if r * most <= best:
                    break
                low = n - r
                for kind in range(2 if len(who) == 1 else 1):
                    fits = self.bits[kind].get(r, 0) >> low
                    if fits:
                        y = low + (fits & -fits).bit_length() - 1
                        if y < n and (n - y) * (most - r + n - y) > best:
                            best, found = (n - y) * (most - r + n - y), (n, who, r, -y if kind else y)
        if found is None:
            return None
        _, who, r, back = found
        return best, who, min(self.held[back < 0][r][abs(back)] if back else self.open[r]), back


def swaps(bins: list[list[int]], lengths: np.ndarray, size: int, rounds: int = ROUNDS) -> list[list[int]]:
    """Local search between underfull bins; a bin that is empty at the end is left out.

    The emptiest bins give first: one piece (moved, or for one or two of another bin), or two (moved, or for one), to a bin at least
    as full, where the squared fill rises most. Ends at the least number of bins that could
    hold all, without a step in a whole round, or after so many rounds.
    """
    size_of = lengths.tolist()
    bins = [list(b) for b in bins]
    least = -(-sum(size_of) // size)
    left = sum(map(bool, bins))
    rooms = _Rooms(bins, size_of, size)
    for b in range(len(bins)):
        rooms.add(b)
    for _ in range(rounds):
        better = False
        for give in sorted((b for found in rooms.open.values() for b in found), key=lambda b: (-rooms.room(b), b)):
            if left <= least:
                break
            rooms.remove(give)
            while bins[give]:
                mine = bins[give]
                sent: dict[int, tuple] = {}
                for k, i in enumerate(mine):
                    sent.setdefault(size_of[i], (i,))
                for k, i in enumerate(mine[:PAIRED]):
                    for j in mine[:k]:
                        sent.setdefault(size_of[i] + size_of[j], (i, j))
                step = rooms.best(sent, rooms.room(give))
                if step is None:
                    break
                _, who, take, back = step
                rooms.remove(take)
                theirs = bins[take]
                if back > 0:
                    returned = [next(i for i in theirs if size_of[i] == back)]
                elif back < 0:
                    returned = next([i, j] for k, i in enumerate(theirs[:PAIRED]) for j in theirs[:k] if size_of[i] + size_of[j] == -back)
                else:
                    returned = []
                bins[take] = [i for i in theirs if i not in returned] + list(who)
                bins[give] = [i for i in mine if i not in who] + returned
                rooms.add(take)
                better = True
            left -= not bins[give]
            rooms.add(give)
        if left <= least or not better:
            break
    return [b for b in bins if b]


def pack(items: DataFrame, size: int, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to rows with length (1 to size) and at (a number of its own for each row)."""
    short = items.where(F.col("length") < size)
    n_groups = max(1, -(-short.count() // group))
    schema = items.drop("at").schema.add("sequence_id", "long", False).add("offset", "long", False)
    names = schema.names

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at", ignore_index=True)
        lengths, first = pdf["length"].to_numpy(), int(pdf["_group"].iloc[0]) << 32
        bins = swaps(best_fit(lengths, size), lengths, size)
        order = np.array([i for b in bins for i in b], np.int64)
        seq = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        offset = np.concatenate([np.cumsum(lengths[b]) - lengths[b] for b in bins])
        return pdf.iloc[order].assign(sequence_id=first + seq, offset=offset)[names]

    packed = short.withColumn("_group", F.pmod(F.xxhash64("at"), F.lit(n_groups))).groupBy("_group").applyInPandas(run, schema)
    whole = items.where(F.col("length") == size).select(*items.drop("at").columns, (-1 - F.col("at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 1024) -> DataFrame:
    """Every piece of every document with its place.

    Null text is empty: a piece of one end id. Repeated rows are packed as often as they occur; a null doc_id stays null; an
    empty table gives no rows; other columns take no part.
    """
    spark = docs.sparkSession
    return pack(rows.saved(pieces(docs, vocabulary, size), rows.shared_dir(spark)), size)
