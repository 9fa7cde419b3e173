"""Calibration windows: training rows in hash order, tokenized only as far as the budget goes, cut to exact windows and published in a pair."""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import groups
from corpusloom.operators.sampling import exact_budget, strict_rows
from corpusloom.sources import tables

# slices goes to the executors by value, as those may not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The tag of the order, and the files that name a tokenizer.
TAG = "nvfp4-calibration-v1"
TOKENIZER_FILES = ("tokenizer.json", "tokenizer_config.json", "chat_template.jinja")
#: Ranges of the hash order, and bytes of text that a token is first taken to stand for.
RANGES, BYTES_PER_TOKEN = 4096, 4.0
#: Bytes of an Arrow batch that are Python objects at a time.
SLICE = 1 << 20


def tokenizer_hashes(spark: SparkSession, path: str, names: tuple = TOKENIZER_FILES) -> DataFrame:
    """name, sha256 of a tokenizer's files; raises with the names that are missing (files of 0 bytes are)."""
    there = tables.files(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "sha256").where(F.regexp_replace("path", "^file:/+", "/") == F.concat(F.lit(path.rstrip("/").split("://")[-1].removeprefix("file:") + "/"), "name"))
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    missing = wanted.join(there, "name", "left_anti").agg(F.array_sort(F.collect_list("name"))).collect()[0][0]
    if missing:
        raise ValueError(f"the tokenizer lacks {', '.join(missing)}")
    return wanted.join(there, "name").select("name", "sha256")


def chat_text(messages: Column) -> Column:
    """Messages as text, each after its role."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<"), m["role"], F.lit(">"), m["content"])), "\n")


def slices(batches, size: int = SLICE):
    """Record batches cut so that the bytes of a slice stay near size: token ids as Python objects take many times their bytes."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(size, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def tokenized(rows: DataFrame, encode: Callable, eos: int) -> DataFrame:
    """id and range of rows (id, text, range) with ids, ending in one eos, n, and before: the ids of the task's earlier rows of that range. Raises on
    ids that aren't integers of 0 and more, naming the row."""
    kinds = rows.select("id", "range", F.array().cast("array<int>").alias("ids"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("before")).schema

    def run(batches):
        sums = {}
        for batch in slices(batches):
            d = batch.to_pydict()
            found = encode(d["text"])
            out, before = [], []
            for name, r, ids in zip(d["id"], d["range"], found, strict=True):
                if not isinstance(ids, list) or any(not isinstance(i, int) or isinstance(i, bool) or i < 0 for i in ids):
                    raise ValueError(f"{name}: the tokenizer returned invalid ids")
                out.append(ids if ids and ids[-1] == eos else [*ids, eos])
                before.append(sums.get(r, 0))
                sums[r] = before[-1] + len(out[-1])
            columns = {"ids": pa.array(out, pa.list_(pa.int32())), "n": pa.array([len(i) for i in out], pa.int32()), "before": pa.array(before, pa.int64())}
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "range": batch.column("range"), **columns})

    return rows.select("id", "text", "range").mapInArrow(run, kinds)


def prefix(rows: DataFrame, encode: Callable, eos: int, required: int, tag: str = TAG) -> DataFrame:
    """id, range, ids, n, before of rows (id, text) of whole ranges of the hash order that hold required tokens, or of all.

    Bytes are summed by range first. Then ranges are tokenized, in order, as far as the rest of the budget should need by the bytes a token
    took so far; each wave is written, without its texts. So what isn't needed isn't tokenized, but for a part of the last wave. The rows are read
    again for each wave: a copy of them all would be larger than what is tokenized. Texts are brought together by range and put in order, as they
    take a fraction of their ids' bytes, and ids are added up as they are made.
    """
    spark = rows.sparkSession
    folder = tables.scratch(spark, "calibration")
    h = F.sha2(F.concat(F.lit(tag), F.lit("\0"), F.col("id")).cast("binary"), 256)
    d = rows.select("id", "text", h.alias("_h"), F.conv(F.substring(h, 1, 3), 16, 10).cast("int").alias("range"))
    # at most RANGES numbers
    sizes = {r["range"]: r["b"] for r in d.groupBy("range").agg(F.sum(F.octet_length("text") + 1).alias("b")).collect()}
    done, tokens, seen, waves = 0, 0, 0, []
    while tokens < required and any(r >= done for r in sizes):
        rate = seen / tokens if tokens else BYTES_PER_TOKEN
        aim, end, held = 1.05 * rate * (required - tokens), done, 0
        while end < RANGES and held < max(aim, 1):
            held += sizes.get(end, 0)
            end += 1
        placed = d.where((F.col("range") >= done) & (F.col("range") < end)).repartition("range").sortWithinPartitions("range", "_h", "id")
        wave = tables.saved(tokenized(placed, encode, eos), f"{folder}/wave-{len(waves)}")
        tokens += wave.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
        seen, done = seen + held, end
        waves.append(wave)
    if not waves:
        return tokenized(d.limit(0), encode, eos)
    out = waves[0]
    for w in waves[1:]:
        out = out.unionByName(w)
    return out


def windows(rows: DataFrame, encode: Callable, decode: Callable, eos: int, size: int, count: int, tag: str = TAG) -> tuple[DataFrame, DataFrame]:
    """(window, ids, text; id, start of the selected rows): count windows of size tokens from rows (id, text).

    Raises where eos isn't an integer of 0 and more, where the rows have too few tokens, and where a window's text doesn't encode to its ids.
    """
    if not isinstance(eos, int) or isinstance(eos, bool) or eos < 0:
        raise ValueError("the tokenizer must define one EOS id of 0 or more")
    folder = tables.scratch(rows.sparkSession, "windows")
    found = prefix(rows, encode, eos, size * count, tag)
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    if total < size * count:
        raise ValueError(f"the rows have {total} tokens; {size * count} are required")
    # at most RANGES rows; the lists of ids aren't moved for it
    sums = found.groupBy("range").agg(F.sum("n").alias("n"))
    first = sums.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    selected = found.join(F.broadcast(first), "range").withColumn("start", F.col("_first") + F.col("before")).where(F.col("start") < size * count)
    cut = groups.windows(selected, "ids", "start", size, count)
    kinds = cut.select("*", F.lit("").alias("text")).schema

    def run(batches):
        for batch in slices(batches):
            ids = batch.column("ids").to_pylist()
            texts = decode(ids)
            for w, own, back in zip(batch.column("window").to_pylist(), ids, encode(texts), strict=True):
                if own != back:
                    raise ValueError(f"window {w} isn't the same after decoding and encoding")
            yield pa.RecordBatch.from_pydict({"window": batch.column("window"), "ids": batch.column("ids"), "text": texts})

    made = tables.saved(cut.mapInArrow(run, kinds), f"{folder}/windows")
    return made, selected.select("id", "start")


def publish(rows: DataFrame, tokenizer: str, encode: Callable, decode: Callable, eos: int, out: str, size: int = 4096, count: int = 512, names: tuple = TOKENIZER_FILES) -> tuple[str, str]:
    """Write count windows of training rows (id, messages) and their manifest: both or neither, never over what is there.

    The manifest has a row: the selected ids in order, the digests of the tokenizer's files and of the windows' texts in order, and the numbers.
    """
    spark = rows.sparkSession
    for path in (out, f"{out}.manifest"):
        if tables.exists(spark, path):
            raise FileExistsError(path)
    files = tokenizer_hashes(spark, tokenizer, names)
    texts = strict_rows(rows).select("id", chat_text(F.col("messages")).alias("text"))
    made, selected = windows(texts, encode, decode, eos, size, count)
    faults = exact_budget(made, "ids", size, count).collect()
    if faults:
        raise ValueError(faults[0]["message"])
    # the ids of the rows within the budget and a digest for each window: both are bounded by the budget
    order = selected.agg(F.transform(F.array_sort(F.collect_list(F.struct("start", "id"))), lambda x: x["id"]).alias("selected"))
    digest = made.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window", F.sha2("text", 256).alias("d")))), lambda x: x["d"]), ""), 256).alias("sha256"))
    by_name = files.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "sha256")))).alias("tokenizer"))
    numbers = [F.lit(count).alias("samples"), F.lit(size).alias("sequence_length"), F.lit(size * count).alias("tokens")]
    manifest = order.join(F.broadcast(digest)).join(F.broadcast(by_name)).select("selected", "tokenizer", "sha256", *numbers)
    tables.publish_pair(made.select("window", "text"), manifest, out, f"{out}.manifest")
    return out, f"{out}.manifest"
