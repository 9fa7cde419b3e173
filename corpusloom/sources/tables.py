"""Scans and sinks: strict JSON lines, CSV ledgers, content-addressed objects, upserts, manifests and reports."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions import ledger

#: Columns in which a new value alone doesn't make a new row.
VOLATILE = ("created_at", "retrieved_at")
#: Rows of a task whose work on a row is long.
SHARE = 8192


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder. Where none is set: a temporary folder, on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = set_.get() if set_.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """The frame, written and read again: its lineage ends there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_out(df: DataFrame, key: str, rows: int = SHARE) -> DataFrame:
    """The frame dealt by a key over a task for every so many rows, where work on a row is long: a file of few bytes would make one task
    of however many rows."""
    return df.repartition(max(1, -(-df.count() // rows)), key)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON value per file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One object per line; blank lines are skipped, a bad line fails the read, a missing path is an empty table."""
    kinds = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    if not exists(spark, path):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).option("mode", "FAILFAST").json(path)


def csv_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings (empty where a row is short), with quoted line feeds, and bytes that aren't UTF-8 replaced."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    return df.select(*[F.coalesce(F.make_valid_utf8(c), F.lit("")).alias(c) for c in df.columns])


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, bytes of every file below a path."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def pinned(found: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """Files that don't have the digest they are pinned to, and pins without a file."""
    e = expected.select(key, F.col("sha256").alias("expected"))
    return e.join(found, key, "left").where(~F.col("sha256").eqNullSafe(F.col("expected"))).select(key, "expected", "sha256")


def numbered(df: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """Row numbers from 1 within a file or source."""
    return df.withColumn("index", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def canonical(*columns: str | Column) -> Column:
    """JSON with sorted keys, no spaces and explicit nulls."""
    return F.to_json(F.parse_json(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def upsert(old: DataFrame, new: DataFrame, key: str, volatile: tuple = VOLATILE, position: str | None = None) -> DataFrame:
    """Rows by key: the new one where it differs in more than volatile columns, else the old one. Of several new rows of a key the last by position counts, the greatest of those with one position or without positions."""
    columns = old.columns
    row = F.struct(*[F.col(c) for c in columns])
    n = new.groupBy(key).agg(F.max_by(row, F.struct(F.col(position).alias("_at"), row.alias("_row"))).alias("n") if position else F.max(row).alias("n"))
    o = old.select(F.col(key).alias("_key"), row.alias("o"))
    stable = [c for c in columns if c not in volatile]
    same = F.lit(True)
    for c in stable:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    both = n.join(o, F.col(key) == F.col("_key"), "full_outer")
    # a missing side gives nulls, which could look like a row of nulls
    kept = F.when(F.col("n").isNull() | (F.col("o").isNotNull() & same), F.col("o")).otherwise(F.col("n"))
    return both.select(kept.alias("r")).select("r.*")


def new_objects(found: DataFrame, there: DataFrame) -> DataFrame:
    """Objects to write: one per digest that isn't there yet."""
    return found.dropDuplicates(["sha256"]).join(there.select("sha256"), "sha256", "left_anti")


def conflicting(found: DataFrame, there: DataFrame) -> DataFrame:
    """Objects whose name there holds other content than its digest says: (sha256, actual). None of them may be written over."""
    t = there.select("sha256", "actual").where("sha256 != actual")
    return found.select("sha256").distinct().join(t, "sha256")


def write_sorted(df: DataFrame, key: str, path: str) -> None:
    """Canonical JSON lines in the order of a key over all files, by their names."""
    df.orderBy(key).select(canonical(*df.columns).alias("value")).write.mode("errorifexists").text(path)


def write_new(df: DataFrame, path: str) -> None:
    """Fails where something is there."""
    df.write.mode("errorifexists").parquet(path)


def check_only(df: DataFrame) -> None:
    """Compute everything, write nothing."""
    df.write.format("noop").mode("overwrite").save()


def publish_pair(first: DataFrame, second: DataFrame, first_path: str, second_path: str) -> None:
    """Both tables or neither: written aside, then renamed; the first is taken back if the second can't be put in place."""
    spark = first.sparkSession
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(first_path).getFileSystem(spark._jsc.hadoopConfiguration())
    for p in (first_path, second_path):
        if fs.exists(make(p)):
            raise FileExistsError(p)
    aside = [f"{first_path}._aside", f"{second_path}._aside"]
    try:
        first.write.mode("overwrite").parquet(aside[0])
        second.write.mode("overwrite").parquet(aside[1])
        if not fs.rename(make(aside[0]), make(first_path)):
            raise OSError(first_path)
        if not fs.rename(make(aside[1]), make(second_path)):
            fs.delete(make(first_path), True)
            raise OSError(second_path)
    finally:
        for p in aside:
            fs.delete(make(p), True)


def manifest_rows(df: DataFrame, layer: str, producer: str) -> DataFrame:
    """Manifest rows for (relative_path, content, source_id, inputs, created_at)."""
    sha = F.sha2("content", 256)
    return df.select(
        F.concat_ws(":", F.lit(layer), "source_id", F.substring(sha, 1, 16)).alias("record_id"), F.lit(layer).alias("layer"), "relative_path", sha.alias("sha256"), F.length("content").cast("long").alias("bytes"),
        ledger.mime(F.col("relative_path")).alias("mime_type"), "created_at", F.lit(producer).alias("producer"), F.array_sort(F.array_distinct("inputs")).alias("input_refs"), "source_id",
    )


def report(df: DataFrame) -> DataFrame:
    """A one-row table as one JSON line."""
    return df.select(canonical(*df.columns).alias("report"))


def raw_url(repository: Column, revision: Column, path: Column) -> Column:
    """Where a repository host serves one file of one revision as it is."""
    name = F.regexp_replace(F.regexp_replace(F.parse_url(repository, F.lit("PATH")), "^/+|/+$", ""), r"\.git$", "")
    return F.concat_ws("/", F.lit("https://raw.githubusercontent.com"), name, revision, path)


def child_id(parent: Column, path: Column) -> Column:
    """Id of a file's source below its repository's."""
    return F.concat(parent, F.lit("-"), F.lower(F.replace(F.replace(path, F.lit("/"), F.lit("-")), F.lit("."), F.lit("-"))))


def collected(rows: DataFrame, hosts: DataFrame, banned: list[str]) -> DataFrame:
    """status and reason of declared (source_id, title, url) rows: hosts in the table (host) only, without banned words."""
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    text = F.lower(F.concat_ws(" ", "title", "url"))
    word = F.coalesce(*[F.when(text.contains(b), F.lit(b)) for b in banned], F.lit(None).cast("string"))
    rows = rows.join(hosts.select(F.col("host").alias("_host")).where("_host is not null").distinct(), host == F.col("_host"), "left")
    reason = F.when(F.col("_host").isNull(), "host").when(word.isNotNull(), F.concat(F.lit("word "), word))
    return rows.withColumn("reason", reason).withColumn("status", F.when(reason.isNull(), "collected").otherwise("failed")).drop("_host")


def reusable(registry: DataFrame, objects: DataFrame, refresh: bool = False) -> DataFrame:
    """Registry rows whose object is there with the recorded digest, none on refresh."""
    there = objects.select(F.col("source_id"), F.col("url").alias("_url"), F.col("sha256").alias("_sha"))
    return registry.join(there, "source_id").where(F.lit(not refresh) & (F.col("status") == "collected") & (F.col("url") == F.col("_url")) & (F.col("sha256") == F.col("_sha"))).select(*registry.columns)
