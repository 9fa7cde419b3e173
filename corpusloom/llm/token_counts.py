"""Token counts of sections or fields: whole texts are encoded once and token spans joined to section spans."""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame

from corpusloom.llm import rows, tokens

RULES = ("start", "end", "most", "share")


class ByteSpans(tokens.ByteIds):
    """Spans of tokens in characters. A token is one number in place of its id: how far the next one starts behind it, and how many
    characters it covers, 16 bits each (no token of a vocabulary is so long)."""

    @staticmethod
    def values(found: list) -> bytes:
        return array("I", [len(t.value) * 65537 for t in found]).tobytes()

    def merged(self, word: str) -> bytes:
        """A token with part of a character's bytes covers the character."""
        if word.isascii():
            return super().merged(word)
        raw, char, n = word.encode(), [], -1
        for b in raw:
            n += b & 0xC0 != 0x80
            char.append(n)
        char.append(len(word))
        out, at = [], 0
        for t in self.model.tokenize(raw.decode("latin-1").translate(self.signs)):
            start, at = at, at + len(t.value)
            out.append(((char[at] - char[start]) << 16) | (char[at - 1] + 1 - char[start]))
        return array("I", out).tobytes()

    @staticmethod
    def _coded(starts: np.ndarray, ends: np.ndarray, length: int) -> bytes:
        ahead = np.diff(np.append(starts, length))
        return ((ahead << 16) | (ends - starts)).astype("<u4").tobytes()

    def whole(self, text):
        spans = np.array(self.library.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        return self._coded(spans[:, 0], spans[:, 1], len(text)) if len(spans) else b""

    def spans(self, texts: list[bytes]) -> list[np.ndarray]:
        """(start, end) in characters of each token of each text."""
        out = []
        for raw in self.ids(texts):
            found = np.frombuffer(raw, "<u4").astype(np.int64)
            ends = np.cumsum(found >> 16)
            starts = ends - (found >> 16)
            out.append(np.stack([starts, starts + (found & 0xFFFF)], 1))
        return out


def attribute(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and how many of its tokens cross its borders.

    Sections are sorted and don't overlap. rule: a token that crosses goes to the section of its first character ("start"), of
    its last ("end"), to the one with most of its characters, ties to the earlier ("most"), or to each by share of characters
    ("share", fractions). A token (or its share) outside all sections isn't counted.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    n = len(starts)
    a, b = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    first = np.maximum(np.searchsorted(starts, a, "right") - 1, 0) if n else np.zeros(len(a), np.int64)
    last = np.maximum(np.searchsorted(starts, b - 1, "right") - 1, 0) if n else first
    count, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not n:
        return count, crossing
    within = lambda s, x: (starts[s] <= x) & (x < ends[s])
    one = (first == last) & within(first, a) & within(first, b - 1)
    count += np.bincount(first[one], minlength=n)
    for t in np.flatnonzero(~one).tolist():
        over = [(s, int(min(b[t], ends[s]) - max(a[t], starts[s]))) for s in range(int(first[t]), int(last[t]) + 1)]
        over = [(s, k) for s, k in over if k > 0]
        for s, _ in over:
            crossing[s] += 1
        if rule == "share":
            for s, k in over:
                count[s] += k / int(b[t] - a[t])
        elif rule == "most":
            if over:
                count[max(over, key=lambda x: (x[1], -x[0]))[0]] += 1
        else:
            s, x = (int(first[t]), a[t]) if rule == "start" else (int(last[t]), b[t] - 1)
            if within(s, x):
                count[s] += 1
    return count, crossing


def lines(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feeds, in characters; an empty text has one empty section."""
    raw = np.frombuffer(text, np.uint8)
    chars = np.cumsum((raw & 0xC0) != 0x80)
    ends = chars[raw == 10]
    n = int(chars[-1]) if len(chars) else 0
    ends = np.append(ends, n) if not len(ends) or ends[-1] < n else ends
    return np.append(0, ends[:-1]), ends


def count(docs: DataFrame, vocabulary: str, rule: str = "start", sections: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, section (from 0), start, end (characters), n_tokens, n_crossing and doc_tokens, one row per section of each text.

    sections: an array<struct<start, end>> column, sorted and apart; None: lines. Null text is empty and has one empty section;
    no section in a given list: no row. Repeated rows give repeated rows. No shuffle.
    """
    number = "double" if rule == "share" else "long"

    def run(parts):
        coder = tokens.shared(ByteSpans, vocabulary)
        for part in parts:
            out = {k: [] for k in (key, "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens")}
            found = part["_sections"] if sections else [None] * len(part[key])
            for doc, t, spans, given in zip(part[key], part["_text"], coder.spans(part["_text"]), found, strict=True):
                if sections:
                    starts, ends = np.array([(s["start"], s["end"]) for s in given or ()], np.int64).reshape(-1, 2).T
                else:
                    starts, ends = lines(t)
                n, crossing = attribute(spans, starts, ends, rule)
                out[key] += [doc] * len(n)
                out["section"] += range(len(n))
                out["start"] += starts.tolist()
                out["end"] += ends.tolist()
                out["n_tokens"] += n.tolist() if rule == "share" else n.astype(np.int64).tolist()
                out["n_crossing"] += crossing.tolist()
                out["doc_tokens"] += [len(spans)] * len(n)
            yield out

    rows.prepare(docs.sparkSession)
    columns = [docs[key], rows.text_bytes(docs, text).alias("_text")] + ([docs[sections].alias("_sections")] if sections else [])
    return rows.map_rows(docs.select(*columns), run, f"{key} {docs.schema[key].dataType.simpleString()}, section int, start long, end long, n_tokens {number}, n_crossing long, doc_tokens long")
