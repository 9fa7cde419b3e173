"""The corpus pipeline: language, quality, near duplicates, packing. Each stage reads what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import jaccard, langid, packing, quality, rows
from corpusloom.llm.tokens import vocabulary

#: Below this mean probability the network can't tell a text's language.
MIN_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; it learns from the labelled rows of docs."""
    return langid.known(docs, langid.fit(docs), MIN_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the distances from their language's references reject."""
    boxed = docs.select(F.struct("*").alias("_row"), "doc_id", "lang", "text")
    return quality.judged(boxed, ["_row"]).where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest doc_id (null last), whether their ids differ or not; rows without
    words all stay. Columns of any name come back as they were."""
    boxed = rows.saved(docs.select(F.monotonically_increasing_id().alias("at"), F.struct("*").alias("row")), f"{rows.shared_dir(spark)}/numbered")
    found = jaccard.grouped(boxed.select(F.col("at").alias("doc_id"), F.col("row.text").alias("text"))).select(F.col("doc_id").alias("at"), "n_shingles", "component_id")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))
    best = found.where("n_shingles > 0").join(boxed.select("at", F.col("row.doc_id").alias("id")), "at").groupBy("component_id").agg(first.alias("first")).select("first.at")
    keep = best.unionByName(found.where("n_shingles = 0").select("at"))
    return boxed.join(keep, "at", "left_semi").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left, in sequences of 1024 tokens."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), 1024)


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("best_fit_packing", best_fit_packing)]
#: The language network and the packing search can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = rows.shared_dir(spark)
    for name, stage in STAGES[:-1]:
        docs = rows.saved(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
