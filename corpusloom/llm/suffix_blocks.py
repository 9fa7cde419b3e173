"""Suffix arrays of a block of text by a difference cover, one bucket of suffixes at a time.

The cover's residues modulo PERIOD have every difference, so any two places meet a sampled place after the same step of less
than PERIOD bytes. The sampled suffixes are ranked first, by doubling. Then each bucket of suffixes (those whose first two bytes
lie in a range) is sorted on its own: by up to PERIOD bytes, and ties by the ranks of the sampled places that both of two
suffixes meet. Beside the text only the sample's ranks and one bucket's arrays are held.
"""

from __future__ import annotations

import numpy as np

#: A perfect difference set: each difference from 1 to PERIOD - 1 occurs once (fixed values).
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Suffixes of a bucket, unless more begin with the same two bytes.
BUCKET = 1 << 17


def _steps() -> np.ndarray:
    """For residues i and j the least step after which both are in the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    out = np.zeros((PERIOD, PERIOD), np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            out[i, j] = next(s for s in range(PERIOD) if inside[(i + s) % PERIOD] and inside[(j + s) % PERIOD])
    return out


STEPS = _steps()
SLOT = np.zeros(PERIOD, np.int64)
SLOT[list(COVER)] = np.arange(len(COVER))


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a little-endian number, without a copy of the text."""
    return np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows of keys, compared key after key."""
    rank = None
    for k in keys:
        k = np.unique(k, return_inverse=True)[1]
        rank = k if rank is None else np.unique(rank * (int(k.max(initial=0)) + 1) + k, return_inverse=True)[1]
    return rank


class Block:
    """A text whose suffixes are compared by their first depth bytes at least."""

    def __init__(self, text: bytes, depth: int = 100):
        self.n, self.depth = len(text), depth
        reach = PERIOD
        while reach < depth:
            reach *= 2
        self.text = np.zeros(self.n + 2 * reach + 2 * PERIOD + 8, np.uint8)
        self.text[: self.n] = np.frombuffer(text, np.uint8)
        self.words = words_at(self.text)
        # places of the sample in order: number = place // PERIOD * len(COVER) + slot
        rounds = self.n // PERIOD + 2
        places = (np.arange(rounds)[:, None] * PERIOD + np.array(COVER)).ravel()
        rank = _dense(*[self.key(places, at) for at in (0, 8, 16)], self.key(places, 24) >> np.uint64(8))
        width = PERIOD
        while width < depth:
            ahead = width // PERIOD * len(COVER)
            after = np.zeros(len(rank), np.int64)
            after[: max(0, len(rank) - ahead)] = rank[ahead:] + 1
            rank = np.unique(rank * (int(after.max(initial=0)) + 1) + after, return_inverse=True)[1]
            width *= 2
        self.rank = rank

    def key(self, places: np.ndarray, at: int) -> np.ndarray:
        """The 8 bytes at so far from each place, as numbers in byte order."""
        return self.words[places + at].byteswap()

    def _sample(self, places: np.ndarray) -> np.ndarray:
        """Ranks of sampled places."""
        return self.rank[places // PERIOD * len(COVER) + SLOT[places % PERIOD]]

    def buckets(self, places: np.ndarray):
        """Places by ranges of their first two bytes, in order, about BUCKET at a time."""
        head = self.words[places].byteswap() >> np.uint64(48)
        sizes = np.bincount(head.astype(np.int64), minlength=1 << 16)
        number = (np.cumsum(sizes) - sizes) // BUCKET
        of = number[head.astype(np.int64)].astype(np.uint32 if number[-1] >= 1 << 16 else np.uint16)
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], of[order][1:] != of[order][:-1]])).tolist() + [len(order)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield places[order[a:b]]

    def sorted_bucket(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A bucket's places in suffix order, and for each whether its first PERIOD bytes are those of the one before."""
        places = places[np.argsort(self.key(places, 0))]
        same = np.zeros(len(places), bool)
        k = self.key(places, 0)
        same[1:] = k[1:] == k[:-1]
        for at in (8, 16, 24):
            tied = same.copy()
            tied[:-1] |= same[1:]
            where = np.flatnonzero(tied)
            if not len(where):
                return places, same
            group = np.cumsum(~same[where])  # of ties: at most half as many as places
            if group[-1] < 1 << 16:
                group = group.astype(np.uint16)
            k = self.key(places[where], at)
            if at == 24:
                k = k >> np.uint64(8)  # 7 bytes: PERIOD in all
            by = np.argsort(k)
            by = by[np.argsort(group[by], kind="stable")]
            places[where] = places[where][by]
            k, group = k[by], group[by]
            again = np.zeros(len(where), bool)
            again[1:] = (k[1:] == k[:-1]) & (group[1:] == group[:-1])
            same[where] = again
        self._by_cover(places, same)
        return places, same

    def _by_cover(self, places: np.ndarray, same: np.ndarray) -> None:
        """Order each run of ties in place: all runs are parted by a pivot at once, again and again, comparing by the cover's ranks."""
        tied = same.copy()
        tied[:-1] |= same[1:]
        where = np.flatnonzero(tied)
        start = ~same[where]  # of the runs
        while len(where):
            run = np.cumsum(start) - 1
            first = np.flatnonzero(start)
            size = np.diff(np.append(first, len(where)))
            here = places[where]
            pivot = here[first + size // 2][run]
            step = STEPS[here % PERIOD, pivot % PERIOD]
            a, b = self._sample(here + step), self._sample(pivot + step)
            side = 1 + (a > b).astype(np.int8) - (a < b)
            by = np.argsort(run * 3 + side, kind="stable")
            places[where] = here[by]
            side, run = side[by], run[by]
            start = np.ones(len(where), bool)
            start[1:] = (side[1:] != side[:-1]) | (run[1:] != run[:-1])
            part = np.cumsum(start) - 1
            open_ = (np.bincount(part)[part] > 1) & (side != 1)  # those like the pivot are at their place
            where, start = where[open_], start[open_]

    def repeats(self, places: np.ndarray) -> np.ndarray:
        """Those places whose first depth bytes also stand at an earlier one of places."""
        found = [np.empty(0, np.int64)]
        for bucket in self.buckets(places):
            at, same = self.sorted_bucket(bucket)
            # neighbours with depth bytes in common: the first PERIOD are known
            pair = np.flatnonzero(same)
            for far in [*range(PERIOD, self.depth - 8, 8), self.depth - 8]:
                pair = pair[self.words[at[pair] + far] == self.words[at[pair - 1] + far]]
            if len(pair):
                alike = np.zeros(len(at), bool)
                alike[pair] = True
                first = np.flatnonzero(~alike)
                least = np.minimum.reduceat(at, first)[np.cumsum(~alike) - 1]
                found.append(at[at > least])
        return np.sort(np.concatenate(found))
