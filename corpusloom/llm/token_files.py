"""Token ids of all documents in files of Simple-8b words, in ascending doc_id order."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import rows, simple8b, tokens

#: The id after each document.
END = 2
NO_DOC = -(1 << 63)


def write(docs: DataFrame, vocabulary: str, folder: str, kind=tokens.LowerIds, end: int = END) -> None:
    """Range-partition by doc_id and write one file image per slice of text, each a row (part, seq, before, payload) of Parquet.

    before: ids of the part's earlier files. Parquet is only the carrier, as it is what every store that Spark writes to
    takes; payload is the whole file. Null text: only the end id. Null doc_id sorts first. Rows with one doc_id stay in
    text order.
    """
    end_bytes = np.array([end], "<u4").tobytes()

    def run(parts):
        ids_of = tokens.shared(kind, vocabulary)
        part_id, before = TaskContext.get().partitionId(), 0
        for seq, part in enumerate(parts):
            ids = [x + end_bytes for x in ids_of.ids(part["_text"])]
            values = np.frombuffer(b"".join(ids), "<u4")
            doc_ids = np.array([NO_DOC if d is None else d for d in part["doc_id"]], np.int64)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            yield {"part": [part_id], "seq": [seq], "before": [before], "n_ids": [len(values)], "payload": [simple8b.to_file(doc_ids, lengths, values)]}
            before += len(values)

    rows.prepare(docs.sparkSession)
    ordered = docs.select(docs["doc_id"].cast("long").alias("doc_id"), rows.text_bytes(docs).alias("_text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_text")
    rows.map_rows(ordered, run, "part int, seq int, before long, n_ids long, payload binary").write.mode("overwrite").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of a folder."""
    files = spark.read.parquet(folder)
    # one number for each partition that wrote: bounded by their count, not by the rows
    totals = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    first, at = {}, 0
    for part in sorted(totals):
        first[part] = at
        at += totals[part]

    def run(parts):
        for part in parts:
            for p, before, payload in zip(part["part"], part["before"], part["payload"], strict=True):
                doc_ids, lengths, values = simple8b.from_file(payload)
                raw = memoryview(values.astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield {"doc_id": [None if d == NO_DOC else d for d in doc_ids.tolist()], "start": (starts + (first[p] + before)).tolist(), "n_tokens": lengths.tolist(), "ids_crc32": crc}

    rows.prepare(spark)
    return rows.map_rows(files.select("part", "before", "payload"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents to a new folder in the shared place and read them back. An empty table has no rows."""
    folder = rows.shared_dir(docs.sparkSession)
    write(docs, vocabulary, folder)
    return read(docs.sparkSession, folder)
