"""Texts as sequences of recurring chunks, each of which is encoded once and remembered.

A chunk is a stretch between white space, so the number of different chunks is far smaller than the number of
chunks. The memory holds two generations of at most CAPACITY chunks each; what it forgets is encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks of a generation; two generations of words and their ids take under 100 MB in a worker.
CAPACITY = 250_000


class Memo:
    """Chunk -> value, with encode(list of chunks) -> list of values for those not known."""

    def __init__(self, encode: Callable[[list], list], capacity: int = CAPACITY):
        self.encode, self.capacity = encode, capacity
        self.now: dict = {}
        self.old: dict = {}

    def found(self, lists) -> list:
        """The values of all chunks of the lists, one after another: one look-up for each chunk that is known."""
        if len(self.now) > self.capacity:
            self.old, self.now = self.now, {}
        now, old = self.now, self.old
        flat = list(chain.from_iterable(lists))
        values = list(map(now.get, flat))
        if None in values:
            places = [i for i, v in enumerate(values) if v is None]
            need = dict.fromkeys([flat[i] for i in places])
            if old:
                for c in need:
                    if (v := old.get(c)) is not None:
                        now[c] = v
                need = [c for c in need if c not in now]
            new = list(need)
            now.update(zip(new, self.encode(new), strict=True))
            for i in places:
                values[i] = now[flat[i]]
        return values

    def numbered(self, lists: pa.ListArray) -> tuple[list, np.ndarray, np.ndarray]:
        """(values of the different chunks, the number of each chunk's value, where each list starts and the last ends)."""
        coded = pc.dictionary_encode(lists.flatten())
        offsets = lists.offsets.to_numpy()
        return self.found([coded.dictionary.view(pa.binary()).to_pylist()]), coded.indices.to_numpy(), offsets - offsets[0]

    def joined(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The values, which are 32-bit numbers as bytes, one after another, and where each list starts and the last ends."""
        values, index, bounds = self.numbered(lists)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat = np.frombuffer(b"".join(values), "<u4")
        counts = sizes[index]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - counts), counts)
        return flat[at], np.concatenate([[0], ends])[bounds]


def white_split(texts: list[bytes]) -> pa.ListArray:
    """Stretches between ASCII white space; an empty one before leading and after trailing white space."""
    return pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))


#: ASCII white space as in the patterns of byte-level vocabularies: one space may lead a chunk.
SPACED = re.compile(rb" ?[^\s]+|\s+(?!\S)|\s+")
#: White space outside ASCII, control characters, or what may be the string of a special token.
ODD = re.compile(rb"[\x00-\x08\x0e-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
CONTROLS = bytes([*range(9), *range(14, 32)])
CUT = re.compile(rb"(?<=[^\s])(?= [^\s])")
#: Marks a text's first chunk, which no space leads.
FIRST = b"\x01"


def is_odd(text: bytes) -> bool:
    """Whether its chunks can't be encoded apart from each other."""
    if b"<|" in text:
        return True
    if text.isascii():
        return len(text.translate(None, CONTROLS)) != len(text)
    return ODD.search(text) is not None


def segments(text: bytes, size: int = 1 << 20):
    """Cut a very long text before a single space, where no token of a byte-level vocabulary crosses."""
    at = 0
    while len(text) - at > size and (m := CUT.search(text, at + size)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


def spaced(text: bytes) -> list[bytes]:
    """Chunks with keys of their own: FIRST leads the first, a line feed leads the first of a later line, a space is left out."""
    if not is_even(text):
        return [c[1:] if c[:1] == b" " and len(c) > 1 and not c[1:2].isspace() else FIRST + c for c in SPACED.findall(text)]
    return (FIRST + text.replace(b"\n", b" \n")).split(b" ") if text else []


def is_even(text: bytes) -> bool:
    """Whether single spaces and line feeds are its only white space, and inside."""
    return not (b"  " in text or b"\n\n" in text or b" \n" in text or b"\n " in text or b"\t" in text or b"\r" in text or b"\x0b" in text or b"\x0c" in text or text[:1] in (b" ", b"\n") or text[-1:] in (b" ", b"\n"))


def spaced_lists(texts: list[bytes]) -> pa.ListArray:
    """spaced() of many texts."""
    if all(map(is_even, texts)) and b"" not in texts:
        return pc.split_pattern(pa.array([FIRST + t.replace(b"\n", b" \n") for t in texts], pa.binary()), b" ")
    return pa.array(list(map(spaced, texts)), pa.list_(pa.binary()))


def spaced_text(key: bytes) -> bytes:
    """What a key of spaced() stands for."""
    return key[1:] if key[:1] == FIRST else key if key[:1] == b"\n" else b" " + key
