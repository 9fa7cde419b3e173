"""Provenance: source records, declared repositories, and checks of manifests, registries, cards and exports.

Checks give rows (check, key, message), as those of checks.py do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import ledger
from corpusloom.operators.checks import broken, gathered
from corpusloom.sources import tables

# Source classes and license states that checks go by.
OFFICIAL, THIRD_PARTY, LIVE = "official", "third_party", "live_reference"
LICENSED = ["compatible", "metadata_only"]
# Files that the secret scan leaves out, by ending and by size, and the pattern that it has beside the others.
SKIPPED, MOST_BYTES = (".pdf", ".sqlite", ".rep"), 20 * 1024 * 1024
FILE_SECRETS = ledger.SECRETS | {"ssh_command": r"\bssh\s+(?:-[^\s]+\s+)*[^\s@]+@[^\s]+"}
# Keys that a public evaluation row must not have.
LABEL_KEYS = ["reference_answer", "outcome"]


def source_record(source_class: Column, locator: Column, status: Column, license_: Column, columns: dict[str, Column] | None = None) -> list[Column]:
    """The columns of a registry row over (source_id, title); what isn't given is null."""
    given = columns or {}
    null = F.lit(None).cast("string")
    names = ["version", "source_date", "retrieved_at", "local_relative_path", "sha256"]
    out = [F.col("source_id"), source_class.alias("source_class"), F.col("title"), locator.alias("locator")]
    out += [given.get(n, null).alias(n) for n in names]
    out += [given.get("bytes", F.lit(None)).cast("long").alias("bytes"), given.get("mime_type", F.lit("application/octet-stream")).alias("mime_type"), given.get("applicability", F.array().cast("array<string>")).alias("applicability")]
    return [*out, license_.alias("license"), status.alias("ingestion_status"), given.get("notes", F.lit("")).alias("notes")]


def locator(**parts: Column) -> Column:
    """url, repository, path, revision and host label, each null where it isn't given."""
    return F.struct(*[parts.get(n, F.lit(None).cast("string")).alias(n) for n in ("url", "repository", "path", "revision", "host_label")])


def license_of(status: Column, identifier: Column | None = None, note: str = "") -> Column:
    return F.struct(status.alias("status"), (F.lit(None).cast("string") if identifier is None else identifier).alias("identifier"), F.lit(note).alias("use_note"))


def web_sources(items: DataFrame, retrieved_at: str) -> DataFrame:
    """Records of fetched pages: source_id, title, url, status, sha256, bytes, mime_type, local_relative_path."""
    keep = {n: F.when(F.col("status") == "collected", F.col(n)) for n in ("sha256", "bytes", "local_relative_path")}
    return items.select(*source_record(F.lit(OFFICIAL), locator(url=F.col("url")), F.col("status"), license_of(F.lit("reference")), keep | {"retrieved_at": F.lit(retrieved_at), "mime_type": F.col("mime_type")}))


def repository_sources(items: DataFrame, repository: str, retrieved_at: str) -> DataFrame:
    """Records of objects of a history: kind git_file (a path at a revision), git_range (a version) or local_file (a path closed at a
    revision). Any other kind raises."""
    kind = F.col("kind")
    revision = F.when(kind == "git_file", F.col("revision")).when(kind == "git_range", F.col("version")).when(kind == "local_file", F.col("closed_at")).otherwise(F.raise_error(F.concat(F.lit("unsupported source kind: "), F.coalesce(kind, F.lit("none")))).cast("string"))
    where = locator(repository=F.lit(repository), path=F.when(kind != "git_range", F.col("path")), revision=revision)
    return items.select(*source_record(F.col("source_class"), where, F.lit("collected"), license_of(F.lit("internal")), {"version": F.col("version"), "retrieved_at": F.lit(retrieved_at), "sha256": F.col("sha256"), "bytes": F.col("bytes")}))


def authored_sources(files: DataFrame, created_at: str, producer: str) -> DataFrame:
    """Records of files that the library itself has made: source_id, title, path, sha256, bytes."""
    kind = F.when(F.col("path").endswith(".jsonl"), "application/x-ndjson").otherwise("application/json")
    given = {"version": F.lit("1.0.0"), "source_date": F.lit(created_at), "retrieved_at": F.lit(created_at), "local_relative_path": F.col("path"), "sha256": F.col("sha256"), "bytes": F.col("bytes"), "mime_type": kind}
    return files.select(*source_record(F.lit("authored_structure"), locator(path=F.col("path"), revision=F.lit(producer)), F.lit("collected"), license_of(F.lit("internal")), given))


def live_references(items: DataFrame, retrieved_at: str) -> DataFrame:
    """Records of what is still changing: its place is registered, its content is never read, so digest and size are null."""
    where = locator(path=F.col("path"), repository=F.col("repository"), revision=F.col("observed_revision"), host_label=F.col("host_label"))
    return items.select(*source_record(F.lit(LIVE), where, F.lit(LIVE), license_of(F.lit("internal")), {"version": F.col("observed_revision"), "retrieved_at": F.lit(retrieved_at)}))


def third_party(repositories: DataFrame, retrieved_at: str) -> tuple[DataFrame, DataFrame]:
    """(records, wanted): a metadata row for each repository, and the files to fetch: the allowed paths of those whose license is
    compatible, with child id, URL and MIME type. Repositories: source_id, title, url, revision, license_status, license, allowed_paths."""
    license_ = license_of(F.col("license_status"), F.col("license"))
    records = repositories.select(*source_record(F.lit(f"{THIRD_PARTY}_metadata_only"), locator(url=F.col("url"), revision=F.col("revision")), F.lit("declared"), license_, {"version": F.col("revision"), "retrieved_at": F.lit(retrieved_at), "mime_type": F.lit("application/vnd.git.repository")}))
    each = repositories.where("license_status = 'compatible'").withColumn("path", F.explode("allowed_paths"))
    mime = F.when(F.lower("path").endswith(".md"), "text/markdown").otherwise("text/plain")
    child = tables.child_id(F.concat(F.col("source_id"), F.lit("-")), F.col("path"))
    wanted = each.select(child.alias("source_id"), F.col("source_id").alias("parent"), "path", tables.raw_url(F.col("url"), F.col("revision"), F.col("path")).alias("url"), mime.alias("mime_type"), "license")
    return records, wanted


def inline_evidence(items: DataFrame, source_id: str = "source_id") -> DataFrame:
    """source_id, content (canonical JSON of the other columns), sha256, bytes of evidence that a configuration holds itself."""
    text = tables.canonical(*[c for c in items.columns if c != source_id])
    return items.select(F.col(source_id).alias("source_id"), text.alias("content")).withColumns({"sha256": F.sha2("content", 256), "bytes": F.octet_length("content").cast("long")})


def manifest_checks(manifest: DataFrame, found: DataFrame, layer: str) -> DataFrame:
    """Of a manifest (record_id, relative_path, sha256, bytes, layer) against files (path, sha256, bytes): files that are missing or
    have another digest or size, rows of another layer, and paths with more than one digest."""
    f = found.select(F.col("path").alias("_path"), F.col("sha256").alias("_sha"), F.col("bytes").alias("_bytes"))
    d = manifest.join(f, F.col("relative_path") == F.col("_path"), "left")
    there = F.col("_path").isNotNull()
    rules = [("file", ~there, "missing"), ("digest", there & ~F.col("sha256").eqNullSafe(F.col("_sha")), "another digest"), ("size", there & ~F.col("bytes").eqNullSafe(F.col("_bytes")), "another size"), ("layer", there & ~F.col("layer").eqNullSafe(F.lit(layer)), "another layer")]
    each = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(c).alias("check"), F.lit(m).alias("message"))) for c, bad, m in rules]))
    one = d.select(F.col("record_id").cast("string").alias("key"), F.inline(each)).select("check", "key", "message")
    several = manifest.groupBy("relative_path").agg(F.min("sha256").alias("lo"), F.max("sha256").alias("hi")).where("lo != hi")
    return one.unionByName(several.select(F.lit("one digest").alias("check"), F.col("relative_path").alias("key"), F.lit("one path has several digests").alias("message")))


def last_per_commit(records: DataFrame, pos: str = "pos") -> DataFrame:
    """Of each commit the row that was read last: a later revision replaces an earlier, incomplete one."""
    return records.groupBy("commit").agg(F.max(F.struct(F.col(pos).alias("_at"), F.struct(*[c for c in records.columns if c != "commit"]).alias("r"))).alias("last")).select("commit", "last.r.*")


def restoration_checks(records: DataFrame) -> DataFrame:
    """Restorations (by the last row of each commit) that don't name what they revert."""
    return broken(last_per_commit(records), "restoration link", F.col("commit"), (F.col("kind") == "restoration") & (F.coalesce("reverts_commit", F.lit("")) == ""), "a restoration without its candidate")


def registry_checks(registry: DataFrame, raw: DataFrame) -> DataFrame:
    """Repeated ids, live content among raw records, official sources without provenance, third-party ones without a license state."""
    key, official = F.col("source_id"), F.col("source_class").startswith(OFFICIAL) & (F.col("ingestion_status") == "collected")
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    repeated = registry.groupBy("source_id").agg(F.count("*").alias("n")).where("n > 1")
    live = registry.where(F.col("source_class").endswith(LIVE)).select("source_id").distinct().join(raw.select("source_id"), "source_id", "left_semi")
    fixed = lambda df, check, message: df.select(F.lit(check).alias("check"), F.col("source_id").cast("string").alias("key"), F.lit(message).alias("message"))
    return gathered(
        fixed(repeated, "source id", "registered twice"), fixed(live, "live", "live content among the raw records"),
        broken(registry, "provenance", key, official & ~(some("locator.url") & some("sha256") & some("local_relative_path")), "incomplete provenance"),
        broken(registry, "license", key, F.col("source_class").startswith(THIRD_PARTY) & ~F.coalesce(F.col("license.status").isin(LICENSED), F.lit(False)), "no compatible license"),
    )


def facts(cards: DataFrame, kinds: tuple = ("immutable_facts", "compiler_observations", "device_measurements")) -> DataFrame:
    """card, kind and the fields of every fact of fact cards (arrays of one struct type)."""
    lists = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("facts")) for k in kinds])
    return cards.select(F.col("architecture_id").alias("card"), F.inline(lists)).select("card", "kind", F.inline("facts"))


def fact_checks(cards: DataFrame) -> DataFrame:
    """Compiler facts need a tool chain and a build, measurements a device and a workload."""
    f, key = facts(cards), F.concat_ws("/", "card", "fact_id")
    lacks = lambda a, b: (F.coalesce(F.col(a), F.lit("")) == "") | (F.coalesce(F.col(b), F.lit("")) == "")
    return gathered(
        broken(f, "compiler fact", key, (F.col("kind") == "compiler_observations") & lacks("toolchain", "build_revision"), "no tool chain or build"),
        broken(f, "device fact", key, (F.col("kind") == "device_measurements") & lacks("hardware_sku", "workload_key"), "no device or workload"),
    )


def card_refs(cards: DataFrame) -> DataFrame:
    """card, refs: the sorted distinct source references of all facts of a card."""
    each = facts(cards).select("card", F.explode("source_refs").alias("ref")).distinct()
    return each.groupBy("card").agg(F.array_sort(F.collect_list("ref")).alias("refs"))


def unknown_sources(deltas: DataFrame, registry: DataFrame) -> DataFrame:
    """Source references of deltas (delta_id, source_refs) that aren't registered."""
    each = deltas.select("delta_id", F.explode("source_refs").alias("source_id")).distinct()
    return each.join(registry.select("source_id"), "source_id", "left_anti").select(F.lit("delta source").alias("check"), F.col("delta_id").cast("string").alias("key"), F.concat(F.lit("unknown source "), "source_id").alias("message"))


def evaluation_checks(public: DataFrame, private: DataFrame, split: str = "split", json: str = "json") -> DataFrame:
    """Ids of a split on one side only, and public rows (JSON text) with a key of a label."""
    a = public.select(F.col(split).alias("_s"), F.col("id").alias("_id"), F.lit(1).alias("_a")).distinct()
    b = private.select(F.col(split).alias("_s"), F.col("id").alias("_id"), F.lit(1).alias("_b")).distinct()
    one = a.join(b, ["_s", "_id"], "full_outer").where("_a is null or _b is null")
    sided = one.select(F.lit("ids").alias("check"), F.col("_id").cast("string").alias("key"), F.when(F.col("_a").isNull(), "no prompt").otherwise("no label").alias("message"))
    shown = F.array_intersect(F.json_object_keys(json), F.array(*[F.lit(k) for k in LABEL_KEYS]))
    return sided.unionByName(broken(public, "label keys", F.col("id"), F.size(F.coalesce(shown, F.array().cast("array<string>"))) > 0, "a label is public"))


def quality_checks(episodes: DataFrame) -> DataFrame:
    """Episodes that say they hold hidden reasoning, or that no passed secret scan covers. Columns episode_id, quality."""
    key = F.col("episode_id")
    return gathered(
        broken(episodes, "hidden reasoning", key, ~F.col("quality.contains_hidden_chain_of_thought").eqNullSafe(F.lit(False)), "hidden reasoning is flagged"),
        broken(episodes, "secret scan", key, ~F.col("quality.secret_scan").eqNullSafe(F.lit("passed")), "no passed secret scan"),
    )


def file_secrets(files: DataFrame) -> DataFrame:
    """check, key, message of files (path, length, content binary) in which a pattern of a secret occurs; some endings and very large
    files are left out. Bytes that aren't UTF-8 are replaced."""
    path = F.lower("path")
    skipped = F.greatest(*[path.endswith(s) for s in SKIPPED])
    text = F.make_valid_utf8(F.col("content").cast("string"))
    found = files.where(~skipped & (F.col("length") <= MOST_BYTES)).select("path", F.explode(ledger.secrets(text, FILE_SECRETS)).alias("name"))
    return found.select(F.lit("secret").alias("check"), F.col("path").alias("key"), F.concat(F.lit("possible "), "name").alias("message"))


def scanned_secrets(spark: SparkSession, path: str) -> DataFrame:
    """file_secrets of every file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return file_secrets(files.where(F.col("length") <= MOST_BYTES))


def schema_files(spark: SparkSession, folder: str) -> DataFrame:
    """name, schema (JSON text) of every *.schema.json of a folder, by name; raises where one isn't JSON."""
    d = spark.read.text(f"{folder.rstrip('/')}/*.schema.json", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0).alias("name"), F.col("value").alias("schema"))
    checked = F.when(F.try_parse_json("schema").isNotNull(), F.col("schema")).otherwise(F.raise_error(F.concat(F.lit("not JSON: "), "name")).cast("string"))
    return d.select("name", checked.alias("schema")).orderBy("name")
