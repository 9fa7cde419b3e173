import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from corpusloom.operators import builder, near_duplicates, provenance, sampling
from corpusloom.sources import tables
from corpusloom.streaming import arrivals

FAILURES = (PySparkException, Py4JJavaError)


def test_assigned_raises_on_unknown_values(spark):
    rows = spark.createDataFrame([("a", "1")], "campaign_id string, cycle string")
    campaigns = spark.createDataFrame([("a", "train", "train")], "campaign_id string, assigned_split string, evaluation_tier string")
    cycles = spark.createDataFrame([("a", "1", "somewhere", None)], "campaign_id string, cycle string, assigned_split string, evaluation_tier string")
    assert builder.assigned(rows, campaigns, cycles.limit(0)).first().assigned_split == "train"
    with pytest.raises(FAILURES, match="invalid split of a cycle 1: somewhere"):
        builder.assigned(rows, campaigns, cycles).collect()


def test_admitted_raises(spark):
    asked = spark.createDataFrame([("ledger", "s")], "role string, source_id string")
    registry = spark.createDataFrame([("s", "official", "collected")], "source_id string, source_class string, ingestion_status string")
    records = spark.createDataFrame([("s", "x.csv")], "source_id string, relative_path string")
    assert builder.admitted(asked, registry, records).count() == 1
    with pytest.raises(FAILURES, match="not registered"):
        builder.admitted(asked, registry.limit(0), records).collect()


def test_evidence_raises_without_record(spark):
    c = spark.createDataFrame([(1, ["s", "t"])], "pos_key long, source_ids array<string>")
    latest = spark.createDataFrame([("s", "r", "2026")], "source_id string, record_id string, created_at string")
    with pytest.raises(FAILURES, match="no raw record of t"):
        builder.evidence(c, latest, spark.createDataFrame([], "source_id string, source_date string")).collect()


def test_unknown_kind_raises(spark):
    d = spark.createDataFrame([("s", "t", "ftp")], "source_id string, title string, kind string").selectExpr("*", "'p' path", "'r' revision", "'v' version", "'c' closed_at", "'x' source_class", "'0' sha256", "1L bytes")
    with pytest.raises(FAILURES, match="unsupported source kind: ftp"):
        provenance.repository_sources(d, "repo", "t").collect()


def test_files_with_secrets(spark, tmp_path):
    (tmp_path / "a.txt").write_text("ssh -4 -p22 root@10.0.0.1")
    (tmp_path / "b.PDF").write_text("AKIA" + "A" * 16)
    (tmp_path / "c.json").write_bytes(b"\xff AKIA" + b"B" * 16)
    (tmp_path / "d.md").write_text("ssh keys are not shown")
    got = {(r.key.rpartition("/")[2], r.message) for r in provenance.scanned_secrets(spark, f"file://{tmp_path}").collect()}
    assert got == {("a.txt", "possible ssh_command"), ("c.json", "possible aws_key")}


def test_schema_files(spark, tmp_path):
    (tmp_path / "b.schema.json").write_text("{}")
    (tmp_path / "a.schema.json").write_text('{\n "type": "object"}')
    (tmp_path / "other.json").write_text("no")
    assert [r.name for r in provenance.schema_files(spark, f"file://{tmp_path}").collect()] == ["a.schema.json", "b.schema.json"]
    (tmp_path / "c.schema.json").write_text("{")
    with pytest.raises(FAILURES, match="not JSON: c.schema.json"):
        provenance.schema_files(spark, f"file://{tmp_path}").collect()


def test_strict_rows(spark):
    kinds = "id string, messages array<struct<role: string, content: string>>"
    fine = spark.createDataFrame([("a", [("user", "x")]), ("b", [("assistant", "")])], kinds)
    assert sampling.strict_rows(fine).count() == 2
    with pytest.raises(ValueError, match="empty"):
        sampling.strict_rows(fine.limit(0))
    bad = spark.createDataFrame([("a", [("user", "x")]), ("a", [("user", None)]), (None, []), ("c", [("boss", "x")]), ("d", None)], kinds)
    found = sorted((r.key, r.message) for r in sampling.row_faults(bad).collect())
    assert found == [("", "no id"), ("", "no messages"), ("a", "invalid message"), ("a", "repeated id"), ("c", "invalid message"), ("d", "no messages")]
    with pytest.raises(ValueError, match="repeated id"):
        sampling.strict_rows(bad.where("id = 'a'"))


def test_round_trips(spark):
    d = spark.createDataFrame([(1, "ab"), (2, "é"), (3, None)], "id long, text string")
    bad = sampling.round_trips(d, lambda texts: [[ord(c) for c in t] for t in texts], lambda ids: ["".join(map(chr, (i for i in x if i < 128))) for x in ids])
    assert [r.id for r in bad.collect()] == [2]


def closure(rows, n):
    label = list(range(len(rows)))
    while True:
        before = list(label)
        for k in range(n):
            least = {}
            for i, r in enumerate(rows):
                if r[k] is not None:
                    least[r[k]] = min(label[i], least.get(r[k], label[i]))
            label = [min(label[i], least.get(r[k], label[i])) for i, r in enumerate(rows)]
        if label == before:
            return label


def test_split_keys_brute(spark):
    import random

    rng = random.Random(3)
    rows = [tuple(None if rng.random() < 0.3 else f"{k}{rng.randrange(60)}" for k in range(2)) for _ in range(120)] + [(f"c{i // 2}", f"d{(i + 1) // 2}") for i in range(60)] + [("hot", None)] * 80
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a string, b string")
    got = {r.id: r.split_key for r in sampling.split_keys(df, "id", ["a", "b"]).collect()}
    assert got == dict(enumerate(closure(rows, 2)))
    assert sampling.split_keys(df.limit(0), "id", ["a", "b"]).count() == 0


def test_near_duplicates_are_capped(spark):
    words = [f"w{i}" for i in range(60)]
    copies = [(i, " ".join(words[:-1] + [f"x{i}"]), "won") for i in range(6)] + [(10 + i, " ".join(words), "lost") for i in range(5)]
    apart = [(20 + i, " ".join(f"y{i}z{k}" for k in range(60)), "won") for i in range(4)]
    df = spark.createDataFrame(copies + apart, "id long, text string, outcome string")
    got = sorted(r.id for r in near_duplicates.capped_near_duplicates(df, "id", "text", ["outcome"]).collect())
    assert got == [0, 1, 2, 10, 11, 12, 20, 21, 22, 23]


def test_sorted_lines_and_repeated_keys(spark, tmp_path):
    new = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), ("a", 4)], "k string, v int")
    one = tables.upsert(new.limit(0), new, "k")
    tables.write_sorted(one, "k", f"file://{tmp_path}/s")
    lines = [x for f in sorted((tmp_path / "s").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ['{"k":"a","v":4}', '{"k":"b","v":1}', '{"k":"c","v":3}']


def test_folded_versions_survive_replays(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    batch = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    arrivals.fold(batch(("a", 1)), 0, path, "k")
    arrivals.fold(batch(("b", 2)), 1, path, "k")
    arrivals.fold(batch(("b", 9)), 1, path, "k")  # a batch that comes again
    arrivals.fold(batch(("a", 3)), 2, path, "k")
    assert arrivals.versions(spark, path) == ["v00000000", "v00000001", "v00000002"]
    assert {tuple(r) for r in arrivals.current(spark, path).collect()} == {("a", 3), ("b", 2)}
    assert {tuple(r) for r in spark.read.parquet(f"{path}/v00000000").collect()} == {("a", 1)}
    assert not list((tmp_path / "t").glob("_aside*"))
    assert arrivals.current(spark, f"{path}-none") is None


def test_counts_by_window(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"t":"2026-01-01T00:10:00Z","k":"a"}\n{"t":"2026-01-01T00:50:00Z","k":"a"}\n{"t":"2026-01-01T01:10:00Z","k":"b"}\n{"t":"2026-01-02T00:00:00Z","k":"b"}\n')
    stream = spark.readStream.schema("t timestamp, k string").json(f"file://{src}")
    q = arrivals.event_counts(stream, "t", "k").writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.k, str(r.window.start)[11:13], r.n) for r in spark.table("counted").collect()}
    assert got <= {("a", "00", 2), ("b", "01", 1)} and ("a", "00", 2) in got
