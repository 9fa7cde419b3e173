import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from corpusloom.sources import tables

FAILURES = (PySparkException, Py4JJavaError)


def test_json_lines_strict(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"a":1}\n\n{"a":2}\n')
    bad.write_text('{"a":1}\n{"a":\n')
    assert sorted(r.a for r in tables.json_lines(spark, f"file://{good}", "a long").collect()) == [1, 2]
    with pytest.raises(FAILURES):
        tables.json_lines(spark, f"file://{bad}", "a long").collect()
    assert tables.json_lines(spark, f"file://{tmp_path}/none.jsonl", "a long").count() == 0


def test_json_document(spark, tmp_path):
    p = tmp_path / "d.json"
    p.write_text('{\n "a": [1, 2]\n}')
    assert tables.json_document(spark, f"file://{p}", "a array<long>").first().a == [1, 2]


def test_csv_with_quoted_line_feeds(spark, tmp_path):
    p = tmp_path / "l.csv"
    p.write_bytes(b'candidate,result\n1,"two\nlines, ""quoted"""\n2,\n3,bad\xff\n')
    got = [tuple(r) for r in tables.csv_ledger(spark, f"file://{p}").collect()]
    assert got[0] == ("1", 'two\nlines, "quoted"') and got[1] == ("2", "") and got[2][1] == "bad�"


def test_files_and_pins(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.txt").write_text("abc")
    found = tables.files(spark, f"file://{tmp_path}/x")
    r = found.first()
    assert r.sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad" and r.bytes == 3
    assert tables.pinned(found, found.selectExpr("path", "'0' sha256")).count() == 1 and tables.pinned(found, found).count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, "t0"), ("b", 2, "t0"), ("n", None, "t0")], "k string, v int, created_at string")
    new = spark.createDataFrame([("a", 1, "t1"), ("b", 3, "t1"), ("c", 4, "t1"), ("n", None, "t1")], "k string, v int, created_at string")
    assert sorted(map(tuple, tables.upsert(old, new, "k").collect()), key=str) == [("a", 1, "t0"), ("b", 3, "t1"), ("c", 4, "t1"), ("n", None, "t0")]
    twice = spark.createDataFrame([("a", 5, "t1", 0), ("a", 6, "t1", 1)], "k string, v int, created_at string, pos int")
    assert {tuple(r) for r in tables.upsert(old, twice, "k", position="pos").collect()} >= {("a", 6, "t1")}


def test_writes(spark, tmp_path):
    df, path = spark.createDataFrame([("x",)], "line string"), f"file://{tmp_path}/out"
    tables.write_new(df, path)
    with pytest.raises(FAILURES):
        tables.write_new(df, path)
    tables.check_only(df)
    tables.publish_pair(df, df, f"file://{tmp_path}/p1", f"file://{tmp_path}/p2")
    assert spark.read.parquet(f"file://{tmp_path}/p2").count() == 1
    with pytest.raises(FileExistsError):
        tables.publish_pair(df, df, f"file://{tmp_path}/p3", f"file://{tmp_path}/p2")
    assert not tables.exists(spark, f"file://{tmp_path}/p3")


def test_canonical_and_report(spark):
    df = spark.sql("SELECT 'é' b, 1 a, cast(null as string) c")
    assert tables.report(df).first()[0] == '{"a":1,"b":"é","c":null}'


def test_reusable(spark):
    reg = spark.createDataFrame([("s", "u", "x", "collected"), ("t", "u", "y", "failed")], "source_id string, url string, sha256 string, status string")
    assert tables.reusable(reg, reg).count() == 1 and tables.reusable(reg, reg, refresh=True).count() == 0


def test_collected_takes_every_allowed_host(spark, tmp_path):
    from corpusloom.plans import table_queries

    urls = "case when id < 3000 then concat('https://h1', id, '.org/x') when id < 3010 then 'https://h12.org/3' when id < 3020 then 'https://other.org/x' end"
    spark.range(3030).selectExpr("id page_id", f"{urls} url", "'' html").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.status for r in table_queries.collected(spark, str(tmp_path)).collect()}
    assert got == {i: "collected" if i < 3000 else "failed" for i in range(3030)}
