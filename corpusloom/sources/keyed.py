"""A keyed table in buckets: a batch writes what it brings to the buckets that it touches, and a version names what counts.

A version is a manifest of entries (bucket, seq, folder). A commit adds an entry for each bucket with keys of the batch; all other
entries are carried over. A bucket with more than DELTAS entries is rewritten as one. Manifests are written aside and renamed, so a
version is there whole or not at all; nothing that a version names is written again or deleted but by vacuum().
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.tables import VOLATILE

#: Buckets of a table (fixed when it is made), and entries of a bucket before it is rewritten.
BUCKETS, DELTAS = 64, 8
ENTRY = "bucket int, seq long, folder string, n long, buckets int"


def folded(rows: DataFrame, key: str, columns: list[str], volatile: tuple = VOLATILE) -> DataFrame:
    """(bucket, key, row) of rows (bucket, key, seq, row): of each key's rows in the order of seq, the first, then each that differs from the one
    that counts so far in more than volatile columns. A key has a row for each entry of its bucket at most."""
    stable = [c for c in columns if c not in volatile]
    same = lambda a, b: F.forall(F.array(*[a[c].eqNullSafe(b[c]) for c in stable]), lambda x: x) if stable else F.lit(True)
    ordered = rows.groupBy("bucket", "key").agg(F.array_sort(F.collect_list(F.struct("seq", "row"))).alias("all"))
    each = F.transform("all", lambda x: x["row"])
    last = F.aggregate(F.slice(each, 2, F.greatest(F.size(each), F.lit(1))), F.element_at(each, 1), lambda a, b: F.when(same(a, b), a).otherwise(b))
    return ordered.select("bucket", "key", last.alias("row"))


class KeyedTable:
    """Rows by key below a path. The key is a column of the rows; of several rows of a batch the last by position counts, the greatest
    of those with one position or without positions. Columns may have any name."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS, deltas: int = DELTAS, volatile: tuple = VOLATILE):
        self.spark, self.path, self.key, self.deltas, self.volatile = spark, path.rstrip("/"), key, deltas, volatile
        made = self.versions()
        self.buckets = self.manifest(made[-1]).agg(F.max("buckets")).collect()[0][0] or buckets if made else buckets

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the committed versions."""
        path, fs = self._fs()
        folder = path(f"{self.path}/manifests")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def manifest(self, version: int) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/manifests/v{version:012d}")

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _stored(self, entries: list, schema) -> DataFrame:
        """(bucket, key, seq, row) of what entries name: only their folders are listed and read."""
        kinds = self.spark.createDataFrame([], schema).select(F.lit(0).alias("bucket"), F.col(self.key).alias("key"), F.lit(0).cast("long").alias("seq"), F.struct("*").alias("row")).schema
        paths = sorted({f"{self.path}/data/{e['folder']}/part={e['bucket']}" for e in entries})
        return self.spark.read.schema(kinds).option("recursiveFileLookup", True).parquet(*paths) if paths else self.spark.createDataFrame([], kinds)

    def _written(self, rows: DataFrame, number: int) -> list:
        """Write rows (bucket, key, seq, row), a file for each bucket, to a folder of its own; their entries."""
        folder = f"{number:012d}-{uuid.uuid4().hex}"
        target = f"{self.path}/data/{folder}"
        rows.withColumn("part", F.col("bucket")).repartition("bucket").write.partitionBy("part").parquet(target)
        found = self.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(target).groupBy("bucket").agg(F.count("*").alias("n")).collect()
        return [{"bucket": r["bucket"], "seq": number, "folder": folder, "n": r["n"], "buckets": self.buckets} for r in found]

    def _entries(self, version: int | None) -> list:
        """A version's entries: buckets times deltas at most."""
        return [] if version is None else [r.asDict() for r in self.manifest(version).collect()]

    def read(self, schema, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest if none is given), with the schema of the batches."""
        made = self.versions()
        version = version if version is not None else (made[-1] if made else None)
        columns = self.spark.createDataFrame([], schema).columns
        return folded(self._stored(self._entries(version), schema), self.key, columns, self.volatile).select("row.*")

    def commit(self, batch: DataFrame, number: int, position: str | None = None) -> bool:
        """Make version number from the newest one before it and a batch; False if the version is there already (a batch that comes again).

        Buckets without keys of the batch keep their entries; a bucket that would have more than deltas entries is rewritten.
        """
        made = self.versions()
        if number in made:
            return False
        before = [v for v in made if v < number]
        entries = self._entries(before[-1] if before else None)
        row = F.struct("*")
        place = F.struct(F.col(position).alias("at"), row.alias("row")) if position else F.struct(row.alias("row"))
        new = batch.select(F.col(self.key).alias("key"), place.alias("b")).groupBy("key").agg(F.max("b").alias("b"))
        rows = new.select(self._bucket("key").alias("bucket"), "key", F.lit(number).cast("long").alias("seq"), F.col("b.row").alias("row"))
        mine = self._written(rows, number)
        found = self._compacted(entries + mine, batch, number)
        aside = f"{self.path}/manifests/_aside-{uuid.uuid4().hex}"
        self.spark.createDataFrame([tuple(e[c.split()[0]] for c in ENTRY.split(", ")) for e in found], ENTRY).coalesce(1).write.parquet(aside)
        path, fs = self._fs()
        final = path(f"{self.path}/manifests/v{number:012d}")
        if fs.exists(final) or not fs.rename(path(aside), final):
            raise RuntimeError(f"version {number} was committed by another writer")
        return True

    def _compacted(self, entries: list, batch: DataFrame, number: int) -> list:
        """The entries, with one in place of those of each bucket that has too many."""
        many: dict = {}
        for e in entries:
            many.setdefault(e["bucket"], []).append(e)
        full = [e for found in many.values() if len(found) > self.deltas for e in found]
        if not full:
            return entries
        whole = folded(self._stored(full, batch.schema), self.key, batch.columns, self.volatile).select("bucket", "key", F.lit(number).cast("long").alias("seq"), "row")
        gone = {e["bucket"] for e in full}
        return [e for e in entries if e["bucket"] not in gone] + self._written(whole, number)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete older versions than the newest keep, and folders that none of those left names; returns these folders."""
        path, fs = self._fs()
        made = self.versions()
        for v in made[: max(0, len(made) - keep)]:
            fs.delete(path(f"{self.path}/manifests/v{v:012d}"), True)
        named = {e["folder"] for v in made[-keep:] for e in self._entries(v)}
        there = [s.getPath().getName() for s in fs.listStatus(path(f"{self.path}/data"))] if fs.exists(path(f"{self.path}/data")) else []
        gone = [n for n in there if n not in named]
        for n in gone:
            fs.delete(path(f"{self.path}/data/{n}"), True)
        return gone
