"""Subword lattices of many words at once: the probability of a word is the sum over its segmentations into pieces.

A word is a space and its bytes. Pieces are those of an existing vocabulary, and each byte is a piece as well, so that every
word has a segmentation. The recursions are in log space, one step for all words of a length.
"""

from __future__ import annotations

import numpy as np

_MUL = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
BITS = 19
#: Byte positions of the words that are worked on at once.
CELLS = 1 << 18


def existing_pieces(path: str) -> list[bytes]:
    """Pieces of a sentencepiece file as bytes (its space sign as a space at the start only), and every byte; sorted, no repeats."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                found.add(piece)
    return sorted(found)


class Lattice:
    """Pieces with their log probabilities (natural)."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray | None = None):
        self.pieces = pieces
        #: Scores of words that a worker has made for a table.
        self.scored, self.memo = None, None
        self.longest = max(map(len, pieces))
        self.log_p = np.full(len(pieces), -np.log(len(pieces))) if log_p is None else log_p
        # an open-addressed table of all pieces and of their beginnings: at a beginning that is no piece the id is -1
        at_least = sum(map(len, pieces)) * 2
        self.bits = max(BITS, at_least.bit_length())
        size = 1 << self.bits
        self.keys, self.ids = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.taken, self.goes_on = np.zeros(size, bool), np.zeros(size, bool)
        self.probes = 1
        for i, piece in enumerate(pieces):
            h = 1
            for k, b in enumerate(piece, 1):
                h = (h * int(_MUL) + b + 1) & (1 << 64) - 1
                at, n = ((h * int(_MIX)) & (1 << 64) - 1) >> (64 - self.bits), 1
                while self.taken[at] and self.keys[at] != h:
                    at, n = (at + 1) & size - 1, n + 1
                self.keys[at], self.taken[at] = h, True
                if k == len(piece):
                    self.ids[at] = i
                else:
                    self.goes_on[at] = True
                self.probes = max(self.probes, n)

    def _slots(self, h: np.ndarray) -> np.ndarray:
        """Each hash's slot in the table, -1 where it isn't there."""
        at = ((h * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)
        hit, there = self.keys[at] == h, self.taken[at]
        out = np.where(hit & there, at, -1)
        todo = np.flatnonzero(~hit & there)
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = here = (at[todo] + 1) & ((1 << self.bits) - 1)
            hit, there = self.keys[here] == h[todo], self.taken[here]
            out[todo[hit & there]] = here[hit & there]
            todo = todo[~hit & there]
        return out

    def _edges(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """start, end, id of every piece in words x (bytes, (n, B)); places are position * B + word, ascending by end.

        Each start is followed only as far as some piece goes on.
        """
        n, width = x.shape
        flat = x.ravel() + np.uint64(1)
        start = np.arange(n * width)
        h = np.ones(len(start), np.uint64)
        starts, ends, ids = [], [], []
        for k in range(1, min(n, self.longest) + 1):
            h = h * _MUL + flat[start + (k - 1) * width]
            slot = self._slots(h)
            found = self.ids[slot]
            hit = (slot >= 0) & (found >= 0)
            starts.append(start[hit])
            ends.append(start[hit] + k * width)
            ids.append(found[hit])
            on = (slot >= 0) & self.goes_on[slot] & (start + k * width < n * width)
            start, h = start[on], h[on]
            if not len(start):
                break
        start, end, ids = np.concatenate(starts), np.concatenate(ends), np.concatenate(ids)
        order = np.argsort(end, kind="stable")
        return start[order], end[order], ids[order]

    @staticmethod
    def _grouped(words: list[bytes]):
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w) + 1, []).append(i)
        for n, members in by_length.items():
            step = max(1, CELLS // n)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                raw = np.frombuffer(b"".join([b" " + words[i] for i in part]), np.uint8).reshape(-1, n).T
                yield n, np.array(part), raw.astype(np.uint64)

    @staticmethod
    def _sums(n: int, width: int, here: np.ndarray, there: np.ndarray, scores: np.ndarray, places) -> np.ndarray:
        """Log of the summed probabilities of all ways to each place: edges lead there, ascending, from here. places: rows in order.

        The first row of the result that is read is the one that no edge leads to; as every byte is a piece, each other place has
        an edge.
        """
        out = np.full((n + 1) * width, -np.inf)
        first = places[0]
        out[first * width : (first + 1) * width] = 0
        cut = np.flatnonzero(np.diff(there, prepend=-1))
        sizes = np.diff(cut, append=len(there))
        low = int(there[0]) // width if len(there) else 0
        for row in places[1:]:
            seg = slice((row - low) * width, (row - low + 1) * width)
            a, b = cut[seg.start], cut[seg.stop] if seg.stop < len(cut) else len(there)
            terms = out[here[a:b]] + scores[a:b]
            firsts = cut[seg] - a
            top = np.maximum.reduceat(terms, firsts)
            terms -= np.repeat(top, sizes[seg])
            np.exp(terms, out=terms)
            out[row * width : (row + 1) * width] = top + np.log(np.add.reduceat(terms, firsts))
        return out

    def log_probs(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        out = np.zeros(len(words))
        for n, members, x in self._grouped(words):
            start, end, ids = self._edges(x)
            out[members] = self._sums(n, len(members), start, end, self.log_p[ids], range(n + 1))[-len(members) :]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over the words' segmentations, each word counting as often as counts says."""
        out = np.zeros(len(self.pieces))
        for n, members, x in self._grouped(words):
            width = len(members)
            start, end, ids = self._edges(x)
            scores = self.log_p[ids]
            alpha = self._sums(n, width, start, end, scores, range(n + 1))
            back = np.argsort(start, kind="stable")
            beta = self._sums(n, width, end[back], start[back], scores[back], range(n, -1, -1))
            p = np.exp(alpha[start] + scores + beta[end] - np.tile(alpha[-width:], n)[start])
            out += np.bincount(ids, p * np.tile(counts[members].astype(float), n)[start], len(out))
        return out
