"""Generated files that are written only where they changed: versions of sorted lines with a digest of lines and order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import tables

#: Hexadecimal digits of a key's digest that name its leaf, and of a leaf's name that name its branch.
LEAF, BRANCH = 6, 3


def ordered_digest(lines: DataFrame, key: str, value: str = "value") -> str:
    """SHA-256 of the root of a tree over (key, value) rows: of each row; of a leaf's rows in the order of their keys; of a branch's leaves;
    of the 16^BRANCH branches. It tells another value, another key (so another place in the order), and one more or less of a row, whatever the
    partitions. Nothing but the branches meets in one task, and a leaf has 16^-LEAF of the rows."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("\0null"))
    row = F.sha2(F.to_json(F.struct(k.alias("k"), F.col(value).alias("v")), {"ignoreNullFields": "false"}), 256)
    rows = lines.select(F.substring(F.sha2(k, 256), 1, LEAF).alias("leaf"), k.alias("k"), row.alias("row"))
    together = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(c), lambda x: F.concat(x["at"], F.lit(":"), x["digest"])), ","), 256)
    leaves = rows.groupBy("leaf").agg(together(F.collect_list(F.struct(F.sha2("k", 256).alias("at"), F.col("row").alias("digest")))).alias("digest"))
    branches = leaves.groupBy(F.substring("leaf", 1, BRANCH).alias("branch")).agg(together(F.collect_list(F.struct(F.col("leaf").alias("at"), "digest"))).alias("digest"))
    return branches.agg(together(F.collect_list(F.struct(F.col("branch").alias("at"), "digest"))).alias("digest")).collect()[0]["digest"]


def _versions(spark: SparkSession, path: str) -> list[str]:
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(make(path)) if s.getPath().getName().startswith("v")) if fs.exists(make(path)) else []


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest version, which is there whole; its lines are in the order of its files' names. None before the first."""
    found = _versions(spark, path)
    return f"{path}/{found[-1]}" if found else None


def digest_of(version: str) -> str:
    return version.rpartition("-")[2]


def write_if_changed(lines: DataFrame, key: str, path: str, value: str = "value") -> bool:
    """Write lines sorted by key as the next version below path, unless the newest has the same lines in the same order; says whether it wrote.
    Raises on a value of several lines.

    The lines are computed once, aside; what was written before isn't read, as a version's name holds its digest. A version is renamed into
    place, so one that stops on the way leaves the old one, and readers never see a part.
    """
    spark = lines.sparkSession
    aside = tables.scratch(spark, "generated")
    text = F.col(value).cast("string")
    one = F.when(F.coalesce(text.rlike("[\\r\\n]"), F.lit(False)), F.raise_error(F.lit("a value of several lines")).cast("string")).otherwise(text)
    made = tables.saved(lines.select(F.col(key).alias("key"), one.alias("value")), aside)
    digest = ordered_digest(made, "key")
    found = _versions(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        if found and digest_of(found[-1]) == digest:
            return False
        number = int(found[-1][1:].partition("-")[0]) + 1 if found else 1
        hidden = f"{path}/_aside-{uuid.uuid4().hex}"
        made.orderBy("key", "value").select("value").write.text(hidden)
        final = make(f"{path}/v{number:08d}-{digest}")
        if any(v.startswith(f"v{number:08d}-") for v in _versions(spark, path)) or not fs.rename(make(hidden), final):
            raise RuntimeError(f"version {number} was written by another writer")
        return True
    finally:
        folder = make(aside)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
