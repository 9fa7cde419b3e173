"""Simple-8b words: a 4-bit selector and as many values of one width as fit in 60 bits.

Blocks of BLOCK values are coded apart, each from a word of its own, so that all blocks of a file are coded and decoded
together in numpy steps. Selector 0 is the escape: the next word holds one value of more than 60 bits as it is.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
MAGIC = b"CLS8\x01\x00\x00\x00"
#: Fixed values of the code, by selector from 0: values in a word, and bits of each. Selector 1 stands for 120 zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits of each value."""
    if int(values.max(initial=0)) < 1 << 53:  # exact in a float: its exponent says it
        return np.maximum((values.astype(np.float64).view(np.int64) >> 52) - 1022, 0).astype(np.uint8)
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, each block's first word and at last their number)."""
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    blocks = -(-n // BLOCK)
    # behind each block a column too wide for any run, so that runs end there
    flat = np.zeros((blocks, BLOCK + 1), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[:n] = values
    flat[:, :BLOCK] = full.reshape(blocks, BLOCK)
    flat = flat.ravel()
    bits = np.concatenate([_bits(flat), np.full(int(COUNTS.max()), 255, np.uint8)])
    bits[BLOCK : len(flat) : BLOCK + 1] = 255
    bits[(blocks - 1) * (BLOCK + 1) + n - (blocks - 1) * BLOCK : len(flat)] = 255
    # the selector for each place: the longest run of values that are all narrow enough
    selector = np.where(bits[: len(flat)] > 60, 0, 15).astype(np.uint8)
    widest, length = bits[: len(flat)].copy(), 1
    for s in range(14, 0, -1):
        if not (widest <= WIDTHS[s]).any():
            break
        while length < COUNTS[s]:
            np.maximum(widest, bits[length : length + len(flat)], out=widest)
            length += 1
        selector[widest <= WIDTHS[s]] = s
    wide = BLOCK + 1
    at = np.arange(blocks, dtype=np.int64) * wide
    left = np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    ends = at + left
    owner, places = np.arange(blocks), []
    owners = []
    while len(at):
        places.append(at)
        owners.append(owner)
        at = at + COUNTS[selector[at]]
        go = at < ends
        at, owner, ends = at[go], owner[go], ends[go]
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    places, owner = np.concatenate(places)[order], owner[order]
    sel = selector[places].astype(np.int64)
    words = sel.astype(np.uint64) << np.uint64(60)
    counts, widths = COUNTS[sel], WIDTHS[sel]
    for j in range(60):
        some = np.flatnonzero((counts > j) & (sel > 1))
        if not len(some):
            break
        words[some] |= flat[places[some] + j] << (widths[some] * j).astype(np.uint64)
    size = np.where(sel == 0, 2, 1)
    if (sel == 0).any():
        first = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.uint64)
        out[first] = words
        out[first[sel == 0] + 1] = flat[places[sel == 0]]
        words = out
    offsets = np.zeros(blocks + 1, np.int64)
    np.add.at(offsets, owner + 1, size)
    return words, np.cumsum(offsets)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values, all blocks at once."""
    if not n:
        return np.empty(0, np.uint64)
    block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    sel = (words >> np.uint64(60)).astype(np.int64)
    kept = np.ones(len(words), bool)
    escaped = np.zeros(len(words), bool)
    for i in np.flatnonzero(sel == 0).tolist():  # rare: a raw word may look like an escape
        if kept[i]:
            kept[i + 1] = False
            escaped[i] = True
    counts = np.where(kept, COUNTS[sel], 0)
    counts[escaped] = 1
    widths = np.where(escaped, 0, WIDTHS[sel])
    before = np.cumsum(counts) - counts
    inside = np.arange(int(counts.sum())) - np.repeat(before, counts)
    w = np.repeat(widths, counts)
    mask = (np.uint64(1) << np.minimum(w, 60).astype(np.uint64)) - np.uint64(1)
    values = (np.repeat(words, counts) >> (w * inside).astype(np.uint64)) & mask
    if escaped.any():
        values[before[escaped]] = words[np.flatnonzero(escaped) + 1]
    of = np.repeat(block, counts)
    starts = np.zeros(len(offsets) - 1, np.int64)
    sums = np.bincount(of, minlength=len(starts))
    starts[1:] = np.cumsum(sums)[:-1]
    left = np.minimum(BLOCK, n - np.arange(len(starts)) * BLOCK)
    return values[np.arange(len(values)) - starts[of] < left[of]]


def to_file(doc_ids: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> bytes:
    """A file's bytes: magic, numbers of documents, ids, blocks and words, then documents, their lengths, block offsets and words."""
    words, offsets = encode(values)
    head = np.array([len(doc_ids), len(values), len(offsets) - 1, len(words)], "<i8")
    return b"".join([MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


def from_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, values)."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of this format")
    docs, n, blocks, words = np.frombuffer(data, "<i8", 4, 8).tolist()
    at = 40
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    lengths = np.frombuffer(data, "<u4", docs, at := at + 8 * docs).astype(np.int64)
    offsets = np.frombuffer(data, "<u4", blocks + 1, at := at + 4 * docs).astype(np.int64)
    return doc_ids, lengths, decode(np.frombuffer(data, "<u8", words, at + 4 * (blocks + 1)), offsets, n)
