from cases import TEXTS, frame
from pyspark.sql import functions as F
from test_llm_operators import brute_join

import corpus_pipeline


def test_stages_keep_columns_and_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        assert kept.join(docs, docs.columns, "left_anti").count() == 0
    clean = docs.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id").where(F.size(F.split("text", r"\s+")) >= 60).select(*docs.columns)
    for _, stage in corpus_pipeline.STAGES[:2]:
        lost = clean.select("doc_id").subtract(stage(spark, docs, sf).select("doc_id")).count()
        assert lost <= 0.03 * clean.count()


def test_near_duplicates_keep_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).select("doc_id").collect())
    assert got == sorted(d for d, _, c in brute_join([(r.doc_id, r.text) for r in docs.collect()]) if d == c)


def test_near_duplicates_by_row(spark, sf):
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    data = [(1, text("a")), (7, text("a") + " more"), (7, text("b")), (7, text("c") + " and longer"), (None, text("d")), (None, text("d")), (None, text("b")), (None, text("e")), (None, ""), (8, None)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(data, "doc_id long, text string").repartition(3), sf)
    want = [(1, text("a")), (7, text("b")), (7, text("c") + " and longer"), (None, text("d")), (None, text("e")), (None, ""), (8, None)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_awkward_rows(spark, sf):
    docs = frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).collect()
    one = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert one.count() == len(TEXTS) + 1  # repeated rows go, the row without an id stays
    none = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_clashing_columns_come_back(spark, sf):
    """Columns named as the stages and operators name their own."""
    names = ["_row", "row", "at", "_run", "_file", "_text", "_of", "_own", "label", "block", "none", "first", "n_shingles", "kept", "lang_pred", "_words"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(80)
    wide = docs.select("*", *[(F.lit(1000 * (i + 1)) + F.col("doc_id")).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = sorted(r.doc_id for r in stage(spark, docs, sf).select("doc_id").collect())
        got = stage(spark, wide, sf)
        assert got.columns == wide.columns, name
        assert sorted(r.doc_id for r in got.select("doc_id").collect()) == want, name
        assert got.join(wide, wide.columns, "left_anti").count() == 0, name
    corpus_pipeline.STAGES[-1][1](spark, wide, sf).collect()
