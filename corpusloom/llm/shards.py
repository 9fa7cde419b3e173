"""Sharding by size-tiered compaction, in DataFrame operations only.

Arrivals are appended as small immutable shards. Runs of one size tier are merged FAN_IN at a time, in order of arrival,
tier after tier, and what reaches the target is cut into files of at most that size. A manifest version names the shards
that count; it is written aside and renamed, so a reader sees the old or the new version. A later batch is planned together
with the runs of the latest version: what merges is written to a folder of its own, other entries are carried over, and nothing
that a version names is deleted or written again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import rows

ARRIVAL_ROWS = 1024
FAN_IN = 4
TIERS = 3
TARGET_BYTES = 16 << 20
#: Shards are written once and read often; arrivals and merged shards are there at the same time.
CODEC = "zstd"
#: Rows of a mapping that is sent to every task; a longer one is joined by a shuffle.
SENT_RUNS = 200_000


def append(docs: DataFrame, folder: str, arrival_rows: int = ARRIVAL_ROWS) -> DataFrame:
    """Write arrivals (arrival_rows doc_ids each; null ids are arrival -1) as they come, without a shuffle; returns this batch: the rows, boxed, each
    with a number that is written with it."""
    folder = f"{folder}/arrivals/{uuid.uuid4().hex}"
    arrival = F.coalesce(F.floor(docs["doc_id"] / arrival_rows).cast("long"), F.lit(-1).cast("long"))
    boxed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"), arrival.alias("arrival"))
    boxed.write.mode("append").option("compression", CODEC).partitionBy("arrival").parquet(folder)
    return docs.sparkSession.read.schema(boxed.schema).parquet(folder)


def runs_of(arrived: DataFrame) -> DataFrame:
    """run, n_bytes, arrivals of every arrival: metadata, one row each."""
    size = F.coalesce(F.octet_length("row.text"), F.lit(0))
    return arrived.groupBy("arrival").agg(F.sum(size).cast("long").alias("n_bytes")).select(F.col("arrival").alias("run"), "n_bytes", F.array("arrival").alias("arrivals"))


def plan(runs: DataFrame, target: int = TARGET_BYTES, fan_in: int = FAN_IN, tiers: int = TIERS) -> DataFrame:
    """run, n_bytes, arrivals, tier after merging every full set of fan_in runs of a tier, from the smallest tier up.

    A run is of tier t if its bytes are at least target / fan_in^(tiers - t); runs of the target's size or more are done.
    """
    tier = sum((F.col("n_bytes") >= target / fan_in ** (tiers - t)).cast("int") for t in range(1, tiers + 1))
    runs = runs.withColumn("tier", tier)
    for t in range(tiers):
        here = runs.where(F.col("tier") == t).withColumn("_set", F.expr(f"(row_number() OVER (PARTITION BY tier ORDER BY run) - 1) div {fan_in}"))
        merged = here.groupBy("_set").agg(F.min("run").alias("run"), F.sum("n_bytes").alias("n_bytes"), F.array_sort(F.flatten(F.collect_list("arrivals"))).alias("arrivals"), F.count("*").alias("_n"))
        full = merged.where(F.col("_n") == fan_in).select("run", "n_bytes", "arrivals", F.greatest(tier, F.lit(t + 1)).alias("tier"))
        rest = here.join(merged.where(F.col("_n") < fan_in).select("_set"), "_set", "left_semi").drop("_set")
        runs = runs.where(F.col("tier") != t).unionByName(full).unionByName(rest.select("run", "n_bytes", "arrivals", "tier"))
    return runs


def commit(spark: SparkSession, manifest: DataFrame, folder: str) -> int:
    """Write a manifest as the next version: aside first, then renamed in one step. Fails if another writer took the version."""
    version = latest(spark, folder) + 1
    aside = f"{folder}/manifests/_aside-{version:08d}"
    manifest.withColumn("version", F.lit(version).cast("long")).coalesce(1).write.mode("overwrite").parquet(aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(f"{folder}/manifests/v{version:08d}")) or not fs.rename(path(aside), path(f"{folder}/manifests/v{version:08d}")):
        raise RuntimeError(f"version {version} was committed by another writer")
    return version


def latest(spark: SparkSession, folder: str) -> int:
    """The highest committed version, 0 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max([int(x[1:]) for x in names if x.startswith("v")], default=0)


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """shard, run, file, written, tier, n_docs, n_bytes, path, version of a committed version (the latest if none is given)."""
    return spark.read.parquet(f"{folder}/manifests/v{version or latest(spark, folder):08d}")


def documents(spark: SparkSession, folder: str, schema, entries: DataFrame) -> DataFrame:
    """row (a struct of that schema), at, run, file of the documents in the shards that manifest entries name. Only what these versions wrote is
    listed and read: one name for each commit whose shards still count."""
    names = entries.select(F.col("written").alias("_written"), F.col("run").alias("_run"), F.col("file").alias("_file"))
    versions = [r["written"] for r in entries.select("written").distinct().collect()]
    stored = spark.createDataFrame([], schema).select(F.struct("*").alias("row"), F.lit(0).cast("long").alias("at")).schema.add("written", "string").add("run", "long").add("file", "integer")
    if not versions:
        return spark.createDataFrame([], stored).drop("written")
    if entries.count() <= SENT_RUNS:
        names = F.broadcast(names)
    found = spark.read.schema(stored).option("basePath", f"{folder}/shards").parquet(*[f"{folder}/shards/written={v}" for v in versions])
    return found.join(names, (F.col("written") == F.col("_written")) & (F.col("run") == F.col("_run")) & (F.col("file") == F.col("_file")), "left_semi").drop("written")


def compact(arrived: DataFrame, folder: str, target: int = TARGET_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """Plan arrivals with the runs of the latest version, rewrite once what is new or merges, and commit.

    Returns the rewritten documents: row, at, run and file. Arrivals come after all earlier runs, whatever their numbers.
    """
    spark = arrived.sparkSession
    version = latest(spark, folder)
    new, old, last = runs_of(arrived), None, None
    if version:
        old = manifest(spark, folder, version).drop("version")
        last = old.agg(F.max("run")).collect()[0][0]
    if last is not None:
        new = rows.saved(new, f"{folder}/arrived-{version + 1:08d}")
        after = last + 1 - (new.agg(F.min("run")).collect()[0][0] or 0)
        arrived = arrived.withColumn("arrival", F.col("arrival") + after)
        new = new.select((F.col("run") + after).alias("run"), "n_bytes", F.array(F.col("run") + after).alias("arrivals"))
        new = new.unionByName(old.groupBy("run").agg(F.sum("n_bytes").alias("n_bytes")).select("run", "n_bytes", F.array("run").alias("arrivals")))
    runs = rows.saved(plan(new, target, fan_in), f"{folder}/plan-{version + 1:08d}-{uuid.uuid4().hex}")
    stays = F.lit(False) if last is None else (F.col("run") <= last) & (F.size("arrivals") == 1)
    to = runs.where(~stays).select(F.explode("arrivals").alias("arrival"), "run", F.ceil(F.greatest(F.col("n_bytes"), F.lit(1)) / target).cast("int").alias("files"))
    if last is not None:
        merged = old.join(to.select(F.col("arrival").alias("run")), "run", "left_semi")
        arrived = arrived.unionByName(documents(spark, folder, arrived.schema["row"].dataType, merged).drop("file").withColumnRenamed("run", "arrival"))
    if to.count() <= SENT_RUNS:
        to = F.broadcast(to)
    # a run above the target, or one swollen by a repeated id, is dealt over its files by content and by the number written with the
    # row, so that a task that runs again deals alike
    place = F.pmod(F.xxhash64("row.doc_id", "row.text", "at"), F.col("files")).cast("int")
    placed = arrived.join(to, "arrival").select("row", "at", "run", place.alias("file"))
    # a folder that no other version, writer or stopped run has
    name = f"v{version + 1:08d}-{uuid.uuid4().hex}"
    placed.repartition("run", "file").write.option("compression", CODEC).partitionBy("run", "file").parquet(f"{folder}/shards/written={name}")
    written = spark.read.schema(placed.schema).parquet(f"{folder}/shards/written={name}")
    size = F.coalesce(F.octet_length("row.text"), F.lit(0))
    files = written.groupBy("run", "file").agg(F.count("*").alias("n_docs"), F.sum(size).cast("long").alias("n_bytes"))
    entries = files.join(runs.select("run", "tier"), "run").select(
        F.concat_ws("-", "run", "file").alias("shard"), "run", "file", F.lit(name).alias("written"), "tier", "n_docs", "n_bytes", F.format_string(f"shards/written={name}/run=%d/file=%d", "run", "file").alias("path")
    )
    if last is not None:
        entries = entries.unionByName(old.join(runs.where(stays).select("run"), "run", "left_semi"))
    commit(spark, entries, folder)
    return written


def sharded(docs: DataFrame, target: int = TARGET_BYTES, fan_in: int = FAN_IN, arrival_rows: int = ARRIVAL_ROWS) -> DataFrame:
    """doc_id, run, tier, shard_docs, shard_bytes, n_bytes and text_crc32 of each document, read from the committed shards.

    Null text has 0 bytes and a null crc; repeated rows stay; null ids are an arrival of their own; an empty table gives no rows
    and an empty manifest; all other columns are stored, whatever their names.
    """
    spark = docs.sparkSession
    folder = rows.shared_dir(spark)
    written = compact(append(docs, folder, arrival_rows), folder, target, fan_in)
    rows.remove(spark, f"{folder}/arrivals")
    m = manifest(spark, folder).select("run", "file", "tier", F.col("n_docs").alias("shard_docs"), F.col("n_bytes").alias("shard_bytes"), "version")
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    mine = written.select("row.doc_id", "run", "file", size.alias("n_bytes"), F.crc32(F.col("row.text").cast("binary")).alias("text_crc32"))
    if m.count() <= SENT_RUNS:
        m = F.broadcast(m)
    return mine.join(m, ["run", "file"]).select("doc_id", "run", "file", "tier", "shard_docs", "shard_bytes", "n_bytes", "text_crc32", "version")
