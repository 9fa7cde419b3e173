"""BPE encoding and decoding of whole texts by segment trees."""

from __future__ import annotations

import hashlib
from operator import itemgetter

from pyspark.sql import DataFrame

from corpusloom.llm import rows, tokens
from corpusloom.llm.segment_bpe import WordBpe

_IDS, _DIGITS, _NAMES = itemgetter(0), itemgetter(1), itemgetter(2)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """ids array<int> of every whole text, one row for each row. Null or blank text: no ids. No shuffle, no state."""
    import numpy as np

    def run(parts):
        bpe = tokens.shared(WordBpe, path)
        for part in parts:
            yield {key: part[key], "ids": [np.frombuffer(b"".join(map(_IDS, found)), "<u4").tolist() for found in bpe.encode(part["_text"])]}

    rows.prepare(docs.sparkSession)
    return rows.map_rows(docs.select(docs[key], rows.text_bytes(docs, text).alias("_text")), run, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(ids: DataFrame, path: str, key: str = "doc_id", column: str = "ids") -> DataFrame:
    """The text of an id list as the library decodes it: tokens joined by one space where the file names no decoder. Null: empty."""

    def run(parts):
        names = tokens.shared(WordBpe, path).names
        for part in parts:
            yield {key: part[key], "text": [b" ".join([names[i] for i in x or () if 0 <= i < len(names)]).decode() for x in part[column]]}

    rows.prepare(ids.sparkSession)
    return rows.map_rows(ids.select(key, column), run, f"{key} {ids.schema[key].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    Null and blank texts have no tokens and the digests of an empty string; a repeated row gives a repeated row; a null
    doc_id stays null; other columns take no part. The longest text of a batch bounds memory.
    """

    def run(parts):
        bpe = tokens.shared(WordBpe, path)
        for part in parts:
            n, ids, decoded = [], [], []
            for found in bpe.encode(part["_text"]):
                full = [f for f in found if f[0]]
                n.append(sum(map(len, map(_IDS, full))) // 4)
                ids.append(hashlib.sha256(b" ".join(map(_DIGITS, full))).hexdigest())
                decoded.append(hashlib.sha256(b" ".join(map(_NAMES, full))).hexdigest())
            yield {"doc_id": part["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    rows.prepare(docs.sparkSession)
    return rows.map_rows(docs.select("doc_id", rows.text_bytes(docs).alias("_text")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
