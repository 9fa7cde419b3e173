"""Training rows: strict loading, eligibility, indivisible split keys, and caps on near duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources import tables

# Roles of messages.
ROLES = ["system", "user", "assistant", "tool"]
#: Values of a relation are dealt over so many rows each before they are joined back, as one may hold most rows.
SALTS = 32


def row_faults(rows: DataFrame) -> DataFrame:
    """key, message of rows (id, messages array<struct<role, content>>) that can't be trained on: an empty or repeated id, no
    messages, a message of another role or without text."""
    id_ = F.coalesce("id", F.lit(""))
    bad = F.exists("messages", lambda m: m["role"].isNull() | ~m["role"].isin(ROLES) | m["content"].isNull())
    found = F.array_compact(F.array(F.when(id_ == "", "no id"), F.when(F.coalesce(F.size("messages"), F.lit(0)) <= 0, "no messages"), F.when(F.coalesce(bad, F.lit(False)), "invalid message")))
    each = rows.select(id_.alias("key"), F.explode(found).alias("message"))
    twice = rows.where(id_ != "").groupBy(F.col("id").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit("repeated id").alias("message"))
    return each.unionByName(twice)


def strict_rows(rows: DataFrame) -> DataFrame:
    """The rows; raises with the first four faults, or where there is no row."""
    faults = row_faults(rows).select(F.concat_ws(" ", "key", "message").alias("f")).orderBy("f").limit(4).agg(F.array_join(F.array_sort(F.collect_list("f")), "; ").alias("f"))
    some = rows.limit(1).agg(F.count("*").alias("n"))
    state = faults.join(F.broadcast(some)).select(F.when(F.col("n") == 0, "the training export is empty").otherwise(F.col("f")).alias("f")).collect()[0]["f"]
    if state:
        raise ValueError(state)
    return rows


def round_trips(rows: DataFrame, encode, decode, text: str = "text") -> DataFrame:
    """Rows whose text isn't what its ids decode to. encode: list of texts -> list of id lists; decode: the way back; both are
    sent to the workers."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            back = decode(encode([t or "" for t in texts]))
            yield batch.filter(pa.array([(t or "") != b for t, b in zip(texts, back, strict=True)], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def exact_budget(windows: DataFrame, ids: str, size: int, count: int) -> DataFrame:
    """check, key, message where there aren't just count windows of size ids each."""
    g = windows.agg(F.count("*").alias("n"), F.count_if(F.size(ids) != size).alias("odd"))
    found = F.array_compact(F.array(F.when(F.col("n") != count, F.concat(F.col("n").cast("string"), F.lit(" windows"))), F.when(F.col("odd") > 0, F.concat(F.col("odd").cast("string"), F.lit(" windows of another size")))))
    return g.select(F.lit("budget").alias("check"), F.lit("windows").alias("key"), F.explode(found).alias("message"))


#: What an eligible episode needs, by name, over columns of its record.
CONDITIONS: dict[str, str] = {
    "boundary": "boundary != '' and op_family != ''",
    "sources": "size(source_ids) > 0 and license_status in ('compatible', 'internal', 'metadata_only')",
    "cutoff": "evidence_cutoff != ''",
    "workload": "workload != ''",
    "oracle": "correctness in ('passed', 'failed') or exists(limitations, x -> contains(x, 'not_observed'))",
    "units": "forall(measurements, m -> m.unit != '' and m.direction != '')",
    "hardware": "size(architectures) > 0 and size(hardware_skus) > 0",
    "restoration": "disposition != 'rejected' or candidate_commit is null or restoration_commit is not null",
    "secrets": "secret_scan = 'passed'",
    "reasoning": "not hidden_reasoning",
    "review": "review_status != ''",
}


def unmet(episodes: DataFrame, conditions: dict[str, str] | None = None) -> Column:
    """Names of the conditions that a row doesn't meet; one that can't be told (null) isn't met."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(c), F.lit(False)), n) for n, c in (conditions or CONDITIONS).items()]))


def eligible(episodes: DataFrame, conditions: dict[str, str] | None = None) -> DataFrame:
    """The rows that meet every condition."""
    return episodes.where(F.size(unmet(episodes, conditions)) == 0)


def split_keys(rows: DataFrame, id_: str, relations: list[str]) -> DataFrame:
    """id, split_key: the least id that is reached from a row over equal values of any relation column; nulls relate nothing."""
    each = rows.select(F.col(id_).alias("id"), F.explode(F.array(*[F.concat(F.lit(f"{r}="), F.col(r).cast("string")) for r in relations])).alias("value")).where("value is not null")
    return linked_labels(rows.select(F.col(id_).alias("id"), F.col(id_).alias("label")), each).select("id", F.col("label").alias("split_key"))


def linked_labels(start: DataFrame, each: DataFrame) -> DataFrame:
    """id, label: the least label that is reached from an id over values that it shares with others. start: (id, label), each: (id, value).

    Labels go from ids to values and back, with a table written in between, until none falls. A value's ids are aggregated, never
    listed, and its label is joined back over SALTS places. Where labels are ids themselves, a label's own label shortens the way.
    """
    spark = start.sparkSession
    folder = tables.scratch(spark, "labels")
    each = tables.saved(each.distinct().withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), f"{folder}/edges")
    labels = tables.saved(start.distinct(), f"{folder}/labels-0")
    of_ids = labels.schema["id"].dataType == labels.schema["label"].dataType
    step = 0
    while True:
        step += 1
        by_value = each.join(labels, "id").groupBy("value", "_salt").agg(F.min("label").alias("l")).groupBy("value").agg(F.min("l").alias("least"))
        dealt = by_value.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        near = each.join(dealt, ["value", "_salt"]).groupBy("id").agg(F.min("least").alias("least"))
        lower = labels.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", F.coalesce("least", "label")).alias("via"))
        if of_ids:
            far = lower.select(F.col("id").alias("via"), F.col("via").alias("far")).where("via != far")
            lower = lower.join(far, "via", "left").select("id", "old", F.least("via", F.coalesce("far", "via")).alias("via"))
        found = tables.saved(lower.select("id", "old", F.col("via").alias("label")), f"{folder}/labels-{step}")
        labels = found.select("id", "label")
        if not found.where("label < old").limit(1).count():
            return labels
