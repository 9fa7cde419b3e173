"""Shared plumbing: sessions, shared folders and row-wise Arrow functions with bounded batches."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text in one Arrow batch that goes to a Python worker, and in one slice that a worker splits at a time.
BATCH_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
_SHIPPED: dict[str, str] = {}
_KEPT: dict = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker gets at once, whatever the length of the texts, and send it this package."""
    sc = spark.sparkContext
    if _SHIPPED.get("app") != sc.applicationId:
        sc.addPyFile(_package())
        _SHIPPED["app"] = sc.applicationId
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    return spark


def _package() -> str:
    """The package as a zip file for the executors."""
    root = Path(__file__).resolve().parents[1]
    path = Path(_own_dir()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    return str(path)


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir, which all executors see. Unset (as in tests): a temporary folder, on a local
    master only."""
    base = spark.sparkContext._jsc.sc().getCheckpointDir()
    base = base.get() if base.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{_own_dir()}"
    return f"{base.rstrip('/')}/corpusloom-{uuid.uuid4().hex}"


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


def kept(key, make: Callable):
    """What a worker keeps from task to task, for one operator at a time: what another one kept is given back first."""
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)
        _KEPT[key] = make()
    return _KEPT[key]


def saved(df: DataFrame, path: str) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there, and executors may be lost."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, path: str) -> DataFrame:
    """saved(), after which Spark may delete the shuffle files that led there: it does so once the driver has dropped the plans."""
    df = saved(df, path)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return df


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file systems."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_bytes(docs: DataFrame, text: str = "text"):
    """The text as UTF-8 bytes, empty where it is null."""
    return F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")


def map_rows(df: DataFrame, function: Callable[[Iterator[dict]], Iterator[dict]], schema) -> DataFrame:
    """mapInArrow over column slices: function gets {column: list} of at most SLICE_BYTES or one row, and yields {column: list}."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else _parse_datatype_string(schema)
    arrow = to_arrow_schema(kinds)

    def run(batches):
        for out in function(slices(batches)):
            yield pa.RecordBatch.from_arrays([out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kinds)


def slices(batches, size: int = SLICE_BYTES):
    """Cut record batches so that the bytes of a slice stay near size."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * size / max(size, batch.nbytes)))
        for at in range(0, rows, step):
            part = batch.slice(at, step)
            yield {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}


def gathered(parts, least: int):
    """Slices {column: list} joined until they have so many rows, for operators whose steps need many short rows at once."""
    held: dict = {}
    for part in parts:
        for name, values in part.items():
            held.setdefault(name, []).extend(values)
        if len(next(iter(held.values()))) >= least:
            yield held
            held = {}
    if held:
        yield held
