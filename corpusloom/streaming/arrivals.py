"""Structured Streaming over an append-only folder of raw records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import tables
from corpusloom.sources.keyed import KeyedTable


def new_records(spark: SparkSession, path: str, schema: str, key: str = "sha256", time: str = "created_at", late: str = "1 day") -> DataFrame:
    """A stream of records with each digest once within the watermark."""
    return spark.readStream.schema(schema).json(path).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished versions of a keyed table, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("v"))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version, None before the first."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/{found[-1]}") if found else None


def fold(batch: DataFrame, number: int, path: str, key: str) -> None:
    """Upsert a batch into the newest version before its own number and publish the result under that number.

    A version is written aside and renamed, so it is there whole or not at all; no version is written over or deleted. A batch
    that comes again after its version is there changes nothing.
    """
    spark = batch.sparkSession
    name = f"v{number:08d}"
    before = versions(spark, path)
    if name in before:
        return
    before = [v for v in before if v < name]
    old = spark.read.parquet(f"{path}/{before[-1]}") if before else batch.limit(0)
    aside = f"{path}/_aside-{name}-{uuid.uuid4().hex}"
    tables.upsert(old, batch, key).write.parquet(aside)
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(make(aside), make(f"{path}/{name}")):
        raise OSError(f"{path}/{name}")


def upsert_into(stream: DataFrame, path: str, key: str, checkpoint: str):
    """Start a query that folds each batch into a keyed Parquet table of versions; current() reads the newest."""
    return stream.writeStream.foreachBatch(lambda batch, number: fold(batch, number, path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_buckets(stream: DataFrame, table: KeyedTable, checkpoint: str, position: str | None = None):
    """Start a query that commits each batch to a keyed table in buckets, under the batch's number: one that comes again changes nothing."""
    return stream.writeStream.foreachBatch(lambda batch, number: table.commit(batch, number, position) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and key that wait for late rows."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))
