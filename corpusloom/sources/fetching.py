"""Fetching of declared URLs: each executor reads its share, with a cap on bytes and time; what fails is a row, not a failed job."""

from __future__ import annotations

import hashlib
import sys
import time
import urllib.error
import urllib.parse
import urllib.request

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions import ledger
from corpusloom.sources import tables

# fetch goes to the executors by value, as those may not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a source, seconds that a server may be silent, seconds for a whole source, and redirects that are followed.
MAX_BYTES, TIMEOUT, DEADLINE, REDIRECTS = 128 << 20, 60, 600, 5
#: URLs of a task, so that a task that is run again fetches few of them twice.
SHARE = 64
AGENT = "corpus-collector/1"
FETCHED = "source_id string, url string, status string, reason string, http_status int, final_url string, mime_type string, etag string, last_modified string, sha256 string, bytes long, content binary"


class _Moved(Exception):
    """A redirect, which is followed only where its host is allowed."""

    def __init__(self, url: str):
        self.url = url


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, req, fp, code, msg, headers, newurl):
        raise _Moved(newurl)


def fetch(url: str, hosts: set[str] | None = None, etag: str | None = None, last_modified: str | None = None, cap: int = MAX_BYTES, timeout: float = TIMEOUT, deadline: float = DEADLINE, opener: urllib.request.OpenerDirector | None = None) -> dict:
    """Status collected, unchanged (the server says so to etag or last_modified) or failed with its reason, and what the server told.

    Reads at most cap bytes and one more. hosts: those that a URL or a redirect may lead to (None: any); URLs without a host, as data: has
    none, are allowed with them. opener: one that was built before, as building it reads the trusted certificates.
    """
    out: dict = dict.fromkeys(("status", "reason", "http_status", "final_url", "mime_type", "etag", "last_modified", "sha256", "bytes", "content"))
    opener = opener or urllib.request.build_opener(_NoRedirect)
    end = time.monotonic() + deadline
    try:
        for _ in range(REDIRECTS + 1):
            parts = urllib.parse.urlsplit(url)
            if parts.scheme not in ("http", "https", "data"):
                raise ValueError(f"scheme {parts.scheme or 'none'}")
            if hosts is not None and parts.hostname and parts.hostname.lower() not in hosts:
                raise ValueError(f"host {parts.hostname}")
            headers = {"User-Agent": AGENT, "Accept-Encoding": "identity"} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": last_modified} if last_modified else {})
            try:
                with opener.open(urllib.request.Request(url, headers=headers), timeout=timeout) as response:
                    length = response.headers.get("Content-Length")
                    if length and length.isdigit() and int(length) > cap:
                        raise ValueError(f"more than {cap} bytes")
                    data = bytearray()
                    while piece := response.read(min(1 << 16, cap + 1 - len(data))):
                        data += piece
                        if len(data) > cap:
                            raise ValueError(f"more than {cap} bytes")
                        if time.monotonic() > end:
                            raise TimeoutError(f"more than {deadline} seconds")
                    out |= {
                        "status": "collected", "http_status": getattr(response, "status", None), "final_url": url, "mime_type": response.headers.get_content_type(), "etag": response.headers.get("ETag"),
                        "last_modified": response.headers.get("Last-Modified"), "sha256": hashlib.sha256(data).hexdigest(), "bytes": len(data), "content": bytes(data),
                    }
                    return out
            except _Moved as moved:
                url = urllib.parse.urljoin(url, moved.url)
        raise ValueError("too many redirects")
    except urllib.error.HTTPError as e:
        if e.code == 304:
            return out | {"status": "unchanged", "http_status": 304, "final_url": url, "etag": e.headers.get("ETag") or etag, "last_modified": e.headers.get("Last-Modified") or last_modified}
        return out | {"status": "failed", "reason": f"HTTP {e.code}", "http_status": e.code, "final_url": url}
    except Exception as e:  # of a server's making, whatever its kind: the row says so
        cause = getattr(e, "reason", None) or e
        return out | {"status": "failed", "reason": f"{type(cause).__name__}: {cause}"[:300]}


def fetched(declared: DataFrame, hosts: list[str] | None = None, cap: int = MAX_BYTES, timeout: float = TIMEOUT, deadline: float = DEADLINE) -> DataFrame:
    """FETCHED rows of declared (source_id, url, and etag and last_modified where known), SHARE of them to a task; a null url fails.

    What a server says changes from one run to the next: save the result before anything is derived from it.
    """
    allowed = None if hosts is None else {h.lower() for h in hosts}
    known = [F.col(c).cast("string").alias(c) if c in declared.columns else F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified")]
    d = declared.select(F.col("source_id").cast("string").alias("source_id"), F.col("url").cast("string").alias("url"), *known)

    arrow = to_arrow_schema(declared.sparkSession.createDataFrame([], FETCHED).schema)

    def run(batches):
        opener = urllib.request.build_opener(_NoRedirect)
        for batch in batches:
            for row in batch.to_pylist():
                got = fetch(row["url"] or "", allowed, row["etag"], row["last_modified"], cap, timeout, deadline, opener)
                yield pa.RecordBatch.from_pylist([{"source_id": row["source_id"], "url": row["url"]} | got], schema=arrow)

    shares = max(1, -(-d.count() // SHARE))
    return d.repartition(shares).mapInArrow(run, FETCHED)


def collect(declared: DataFrame, hosts: list[str], banned: list[str], registry: DataFrame, objects: DataFrame, refresh: bool, at: str, **limits) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry rows, new objects, manifest rows) of declared (source_id, title, url, mime_type).

    Raises nothing: a host that isn't allowed, a banned word or a failed fetch is a registry row of status failed. Registry rows whose object (source_id,
    url, sha256) is there are taken as they are unless refresh; then the server is asked whether it changed. New objects
    (sha256, content, relative_path) are those whose digest no other has, one each.
    """
    spark = declared.sparkSession
    folder = tables.scratch(spark, "collected")
    allowed = spark.createDataFrame([(h.lower(),) for h in hosts], "host string")
    judged = tables.collected(declared, allowed, banned)
    kept = tables.reusable(registry, objects, refresh)
    asked = judged.where("status = 'collected'").join(kept.select("source_id"), "source_id", "left_anti")
    old = tables.reusable(registry, objects).select("source_id", "etag", "last_modified", F.col("sha256").alias("_sha"), F.col("bytes").alias("_bytes"))
    known = asked.select("source_id", "url").join(old, "source_id", "left")
    got = tables.saved(fetched(known, hosts, **limits), f"{folder}/fetched")
    there = got.join(old.select("source_id", "_sha", "_bytes"), "source_id", "left")
    same = F.col("status") == "unchanged"
    rows = there.select(
        "source_id", "url", F.when(same, "collected").otherwise(F.col("status")).alias("status"), "reason", F.when(same, F.col("_sha")).otherwise(F.col("sha256")).alias("sha256"), F.when(same, F.col("_bytes")).otherwise(F.col("bytes")).alias("bytes"),
        "mime_type", "etag", "last_modified", "final_url", F.lit(at).alias("retrieved_at"),
    )
    refused = judged.where("status = 'failed'").select("source_id", "url", "status", "reason", *[F.lit(None).cast(t).alias(c) for c, t in (("sha256", "string"), ("bytes", "long"), ("mime_type", "string"), ("etag", "string"), ("last_modified", "string"), ("final_url", "string"))], F.lit(at).alias("retrieved_at"))
    every = rows.unionByName(refused).unionByName(kept.select(*rows.columns))
    typed = got.where("status = 'collected'").join(declared.select("source_id", F.col("mime_type").alias("_mime")), "source_id")
    path = F.concat(F.lit("raw/"), "sha256", ledger.ending(F.coalesce("_mime", "mime_type"), F.col("url")))
    found = typed.select("source_id", "url", "sha256", "content", path.alias("relative_path"))
    new = tables.new_objects(found.select("sha256", "content", "relative_path"), objects)
    manifest = tables.manifest_rows(found.select("relative_path", "content", "source_id", F.array("source_id", "url").alias("inputs"), F.lit(at).alias("created_at")), "raw", "fetch@1")
    return every, new, manifest
