"""Whole texts to ids of public BPE vocabularies through the tokenizers library, chunk by chunk.

The library splits a text into words before it merges bytes, so a text's ids are its words' ids joined. Words in ASCII and
Latin letters are cut here by the vocabulary's own pattern and go to the library's merge model; a chunk with any other
character goes through the whole library; so does a text with white space outside ASCII or strings like special tokens.
"""

from __future__ import annotations

import os
import re
from array import array

from corpusloom.llm import chunks, rows

#: Characters whose classes, case and normal form don't depend on a library's Unicode version.
PLAIN = re.compile(r"[\n ]?[\x21-\x7e\xa1-ɏ]+\Z")
#: Bytes above which a text is split in parts.
LONG = 1 << 20
#: Fixed patterns of the two vocabulary files.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOWER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file (a parameter of every operator that takes one)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared(kind, path: str):
    """One object of a kind for a path in each worker."""
    return rows.kept((kind, path), lambda: kind(path))


def byte_signs() -> list[str]:
    """The printable sign of each byte in byte-level vocabularies: itself where it is printable, else the next of U+0100 and up."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    signs, nxt = [], 256
    for b in range(256):
        signs.append(chr(b) if b in own else chr(nxt))
        nxt += b not in own
    return signs


def lowered(text: str) -> str:
    """Each character in lower case by itself, as the library does it: str.lower gives a sigma at a word's end another letter."""
    return text.lower() if text.isascii() else "".join(map(str.lower, text))


class Ids:
    """ids() of texts as little-endian unsigned 32-bit bytes; sub-classes say how chunks are made and cut."""

    pattern, lower = BYTE_WORDS, False

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.cut = regex.compile(self.pattern).findall
        self.signs = dict(enumerate(byte_signs()))
        self.memo = chunks.Memo(self._encode)
        self.marks = {c.encode(): self.merged(c) for c in ".,;:!?"}

    def merged(self, word: str) -> bytes:
        """Ids of one of the pattern's words, by the library's merges."""
        if word.isascii():
            word = word.replace(" ", "Ġ").replace("\n", "Ċ")
        else:
            word = word.encode().decode("latin-1").translate(self.signs)
        return self.values(self.model.tokenize(word))

    @staticmethod
    def values(found: list) -> bytes:
        return array("I", [t.id for t in found]).tobytes()

    def _encode(self, keys: list[bytes]) -> list[bytes]:
        """Letters alone, or before one mark, need no pattern; a chunk outside ASCII and Latin letters goes through the whole library."""
        merged, values, tokenize, cut, plain, marks, spelled, lower, lead = self.merged, self.values, self.model.tokenize, self.cut, PLAIN.match, self.marks, self.text, self.lower, self.lead
        space = " " if lead else ""
        out = []
        for k in keys:
            if k.isalpha():
                out.append(values(tokenize(lead + k.decode())))  # ASCII letters
                continue
            if k[-1:] in marks and k[:-1].isalpha():
                out.append(values(tokenize(lead + k[:-1].decode())) + marks[k[-1:]])
                continue
            t = k.decode("utf-8", "replace")
            if lower:
                t = lowered(t)
            if t.isalpha() and max(t) < "\u0250":
                out.append(merged(space + t))
                continue
            if k[-1:] in marks and t[:-1].isalpha() and max(t) < "\u0250":
                out.append(merged(space + t[:-1]) + marks[k[-1:]])
                continue
            own = spelled(k).decode("utf-8", "replace")
            t = lowered(own) if lower else own
            out.append(b"".join([merged(w) for w in cut(t)]) if plain(t) else self.whole(own))
        return out

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        out: list = [None] * len(texts)
        plain: dict[int, bytes] = {}
        for i, text in enumerate(texts):
            if self.is_odd(text):
                out[i] = self.whole(text.decode("utf-8", "replace"))
            elif len(text) > LONG:
                out[i] = b"".join(b"".join(self.memo.found([x])) for x in self.long(text))
            else:
                plain[i] = text
        if plain:
            flat, bounds = self.memo.joined(self.lists(list(plain.values())))
            raw, bounds = flat.tobytes(), (4 * bounds).tolist()
            for i, a, b in zip(plain, bounds, bounds[1:], strict=False):
                out[i] = raw[a:b]
        return out


class ByteIds(Ids):
    """Byte-level vocabulary whose words may start with a space."""

    text = staticmethod(chunks.spaced_text)
    lists = staticmethod(chunks.spaced_lists)
    is_odd = staticmethod(chunks.is_odd)
    lead = "Ġ"

    def long(self, text: bytes):
        for s in chunks.segments(text):
            yield chunks.spaced(s)


class LowerIds(Ids):
    """Vocabulary that drops white space and case and marks word ends."""

    pattern, lower, lead = LOWER_WORDS, True, ""

    @staticmethod
    def text(key: bytes) -> bytes:
        return key

    @staticmethod
    def lists(texts: list[bytes]):
        return chunks.white_split([t.lower() for t in texts])

    @staticmethod
    def is_odd(text: bytes) -> bool:
        return b"<|" in text

    def long(self, text: bytes):
        for s in chunks.segments(text):
            yield s.lower().split()
