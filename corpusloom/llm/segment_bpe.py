"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs, for many words at once.

The leaves of a word's tree hold rank * 2^b + position for each symbol and its right neighbour. The root is then the
leftmost pair of the lowest rank. A merge changes at most three leaves, and each change goes up one path of the tree.
The trees of all words of one padded length stand in one array, so that one numpy step merges a pair in every word.
"""

from __future__ import annotations

import json
import os

import numpy as np

from corpusloom.llm import chunks, tokens

NONE = np.int64(1) << 62
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Symbols of all trees that are built at once.
CELLS = 1 << 20


class PairTable:
    """(left id, right id) -> rank and merged id, by open addressing."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int64)
        self.merged = merged.astype(np.int64)
        self.probes = 1
        for rank, key in enumerate(pairs.tolist()):
            at, n = ((key * int(_MIX)) & (1 << 64) - 1) >> int(self.shift), 1
            while self.keys[at] >= 0 and self.keys[at] != key:
                at, n = (at + 1) & self.mask, n + 1
            if self.keys[at] < 0:
                self.keys[at], self.ranks[at] = key, rank
            self.probes = max(self.probes, n)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where a side is below 0 or the pair isn't in the table."""
        key = (left << 32) | right
        bad = (left < 0) | (right < 0)
        at = ((key.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)
        out = np.where(self.keys[at] == key, self.ranks[at], NONE)
        todo = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0) & ~bad)
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & self.mask
            hit = self.keys[at[todo]] == key[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (self.keys[at[todo]] >= 0)]
        out[bad] = NONE
        return out


def merge_words(ids: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Words' symbols one after another, and how many each has: the same after merging while a pair is in the table."""
    starts = np.cumsum(lengths) - lengths
    out_lengths = lengths.copy()
    parts, order = [], []
    width_of = np.where(lengths < 2, 1, 1 << np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64))
    for width in np.unique(width_of).tolist():
        members = np.flatnonzero(width_of == width)
        if width == 1:
            members = members[lengths[members] == 1]
            parts.append(ids[starts[members]])
            order.append(members)
            continue
        step = max(1, CELLS // width)
        for at in range(0, len(members), step):
            part = members[at : at + step]
            flat, n = _merge_block(ids, starts[part], lengths[part], width, table)
            parts.append(flat)
            order.append(part)
            out_lengths[part] = n
    ends = np.cumsum(out_lengths)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for got, part in zip(parts, order, strict=True):
        n = out_lengths[part]
        flat[np.repeat(ends[part] - n - (np.cumsum(n) - n), n) + np.arange(len(got))] = got
    return flat, out_lengths


def _merge_block(all_ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    n, depth = len(starts), width.bit_length() - 1
    inside = np.arange(width) < lengths[:, None]
    ids = np.where(inside, all_ids[np.minimum(starts[:, None] + np.arange(width), len(all_ids) - 1)], -1)
    nxt = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
    nxt[~inside] = width
    nxt[np.arange(n), lengths - 1] = width
    prv = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
    tree = np.full((n, 2 * width), NONE, np.int64)
    leaves = table.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
    tree[:, width : 2 * width - 1] = np.where(leaves < NONE, (leaves << depth) | np.arange(width - 1), NONE)
    for level in range(depth - 1, -1, -1):
        lo = 1 << level
        below = tree[:, 2 * lo : 4 * lo]
        tree[:, lo : 2 * lo] = np.minimum(below[:, ::2], below[:, 1::2])
    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        root = tree[live, 1]
        left = root & (width - 1)
        right = nxt[live, left]
        ids[live, left] = table.merged[root >> depth]
        ids[live, right] = -1
        after = nxt[live, right]
        nxt[live, left] = after
        some = after < width
        prv[live[some], after[some]] = left[some]
        before = prv[live, left]
        had = before >= 0
        a = np.concatenate([ids[live, left], ids[live[had], before[had]]])
        b = np.concatenate([np.where(some, ids[live, np.minimum(after, width - 1)], -1), ids[live[had], left[had]]])
        ranks = table.rank(a, b)
        rows = np.concatenate([live, live[had], live])
        where = np.concatenate([left, before[had], right])
        value = np.concatenate([np.where(ranks < NONE, (ranks << depth) | where[: len(ranks)], NONE), np.full(len(live), NONE)])
        tree[rows, where + width] = value
        node = where + width
        for _ in range(depth):
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        live = live[tree[live, 1] < NONE]
    kept = ids >= 0
    return ids[kept], kept.sum(1)


class WordBpe:
    """Encoder and decoder for a vocabulary file of BPE with word ends, as the tokenizers library does.

    A chunk is cut into words by the file's pattern (chunks outside ASCII and Latin letters by the library's normaliser and
    pre-tokenizer); merging is merge_words(). A byte that the vocabulary lacks is left out, as without an unknown token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64).reshape(-1)
        self.table = PairTable(key, np.array([vocab[a + b] for a, b in pairs], np.int64))
        signs = tokens.byte_signs()
        self.sign_byte = {ord(s): b for b, s in enumerate(signs)}
        self.inner = np.array([vocab.get(s, -1) for s in signs], np.int64)
        self.last = np.array([vocab.get(s + end, -1) for s in signs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.around = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names, default=-1) + 1)]
        self.digits = [str(i).encode() for i in range(len(self.names))]
        self.cut = regex.compile(tokens.LOWER_WORDS).findall
        self.memo = chunks.Memo(self._encode)

    def _merge(self, words: list[bytes]) -> list[tuple[bytes, bytes, bytes]]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        ids = self.inner[raw]
        ids[ends - 1] = self.last[raw[ends - 1]]
        if (ids < 0).any():
            kept = ids >= 0
            lengths = np.diff(np.concatenate([[0], np.cumsum(kept)[ends - 1]]))
            ids = ids[kept]
        flat, lengths = merge_words(ids, lengths, self.table)
        raw, found = flat.astype("<u4").tobytes(), flat.tolist()
        digits, names = [self.digits[i] for i in found], [self.names[i] for i in found]
        out, at = [], 0
        for n in lengths.tolist():
            out.append((raw[4 * at : 4 * (at + n)], b" ".join(digits[at : at + n]), b" ".join(names[at : at + n])))
            at += n
        return out

    def _cut(self, chunk: str) -> list:
        """A chunk's words as bytes; a special token as its id."""
        if tokens.PLAIN.match(chunk) and "<" not in chunk:
            return [w.encode() for w in self.cut(chunk.lower())]
        found: list = []
        for part in self.around.split(chunk) if self.around else [chunk]:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                text = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                found += [w.translate(self.sign_byte).encode("latin-1") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return found

    def _encode(self, keys: list[bytes]) -> list[tuple[bytes, bytes, bytes]]:
        cut = [self._cut(k.decode("utf-8", "replace")) for k in keys]
        words = list({w: None for x in cut for w in x if isinstance(w, bytes)})
        known = dict(zip(words, self._merge(words), strict=True)) if words else {}
        out = []
        for x in cut:
            if len(x) == 1 and isinstance(x[0], bytes):
                out.append(known[x[0]])
                continue
            got = [known[w] if isinstance(w, bytes) else (np.array([w], "<u4").tobytes(), self.digits[w], self.names[w]) for w in x]
            got = [g for g in got if g[0]]
            out.append((b"".join([g[0] for g in got]), b" ".join([g[1] for g in got]), b" ".join([g[2] for g in got])))
        return out

    def encode(self, texts: list[bytes]) -> list[list[tuple[bytes, bytes, bytes]]]:
        """For each text its chunks' (ids as unsigned 32-bit bytes, decimal ids, tokens joined by spaces)."""
        values, index, bounds = self.memo.numbered(chunks.white_split([t if b"<|" in t else t.lower() for t in texts]))
        found = list(map(values.__getitem__, index.tolist()))
        return [found[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
