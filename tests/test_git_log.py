"""Histories from log exports, and their topological order."""

import io
import random

import pytest

from corpusloom.operators import topology
from corpusloom.sources import git_log


def record(commit, parents="", body="b", patch="p\n"):
    return b"".join(b"\0" + x + y.encode() for x, y in zip((b"H", b"P", b"T", b"D", b"S", b"B", b"X"), (commit, parents, "t", "2024-01-01T00:00:00Z", "s", body, patch), strict=True))


def test_records_from_any_split():
    """Each record is read once, whatever the split and the size of a read."""
    rng = random.Random(2)
    data = b"".join(record(f"{i:040x}", body="Hx" * rng.randint(0, 9), patch="HH\n" * rng.randint(0, 60)) for i in range(40))
    whole = list(git_log.records(io.BytesIO(data), 0, len(data)))
    assert len(whole) == 40 and b"".join(r for _, r in whole) == data
    for split in (1, 2, 7, 64, 1000, len(data)):
        for step in (1, 3, 50, 1 << 20):
            if split < 7 and step < 50:
                continue
            assert [x for at in range(0, len(data), split) for x in git_log.records(io.BytesIO(data), at, min(at + split, len(data)), step)] == whole


def test_a_source_of_several_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.log").write_bytes(b"".join(record(f"{n}{i}", f"{n}{i - 1}" if i else "", patch="" if i == 2 else "é\n") for i in range(5)))
    (tmp_path / "_ignored").write_bytes(b"x")
    (tmp_path / "empty.log").write_bytes(b"")
    df = git_log.git_log(spark, f"file://{tmp_path}", split=100)
    assert df.rdd.getNumPartitions() > 3
    got = {r.commit: (r.parents, r.patch, r.source) for r in df.collect()}
    assert len(got) == 15 and got["00"] == ([], "é\n", "0.log") and got["12"] == (["11"], "", "1.log")
    few = git_log.git_log(spark, f"file://{tmp_path}", ["commit", "parents"])
    assert few.columns == ["commit", "parents"] and few.count() == 15
    empty = tmp_path / "none"
    empty.mkdir()
    assert git_log.git_log(spark, str(empty)).count() == 0


def test_a_broken_record_fails_the_read(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(record("1") + b"\0H2\0Ponly two")
    with pytest.raises(Exception, match="not a record"):
        git_log.git_log(spark, str(tmp_path)).collect()


def test_files_of_revisions(spark, tmp_path):
    for rev, name, text in (("r1", "a/b.txt", "x"), ("r2", "a/b.txt", "y"), ("r2", "c", "z")):
        f = tmp_path / rev / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)
    got = sorted((r.revision, r.path, bytes(r.content)) for r in git_log.git_files(spark, f"file://{tmp_path}").collect())
    assert got == [("r1", "a/b.txt", b"x"), ("r2", "a/b.txt", b"y"), ("r2", "c", b"z")]


def test_levels_of_random_histories(spark):
    rng = random.Random(7)
    data = []
    for h in range(6):
        for i in range(30):
            some = [f"{h}-{j:03d}" for j in rng.sample(range(i), min(i, rng.choice([0, 1, 1, 1, 1, 2, 3])))]
            data.append((f"{h}-{i:03d}", some + some[:1] + ["outside"] * (i % 3 == 0)))
    data += [(f"line-{i:03d}", [f"line-{i - 1:03d}"] if i else []) for i in range(70)]
    parents = dict(data)

    def level(c):
        own = [p for p in parents[c] if p in parents]
        return 1 + max(map(level, own)) if own else 0

    want = sorted((level(c), c) for c in parents)
    rng.shuffle(data)
    got = sorted((r.position, r.level, r.commit) for r in topology.positions(spark.createDataFrame(data, "commit string, parents array<string>")).collect())
    assert got == [(i, n, c) for i, (n, c) in enumerate(want)]
    assert topology.positions(spark.createDataFrame([], "commit string, parents array<string>")).count() == 0


@pytest.mark.parametrize("data", [[("a", ["b"]), ("b", ["a"])], [("r", []), ("s", []), ("a", ["r", "b"]), ("b", ["s", "a"])], [("r", []), ("a", ["r", "a"])]])
def test_cycles_raise(spark, data):
    with pytest.raises(ValueError, match="cycle"):
        topology.levels(spark.createDataFrame(data, "commit string, parents array<string>"))


def test_small_records_are_read_in_linear_time():
    """Each byte is copied a few times, whatever the number of records in a piece."""

    class Counted(bytes):
        copied = 0

        def __getitem__(self, k):
            out = super().__getitem__(k)
            Counted.copied += len(out)
            return Counted(out)

        def __add__(self, other):
            return Counted(super().__add__(other))

        def __radd__(self, other):
            return Counted(other + bytes(self))

    class File(io.BytesIO):
        asked = 0

        def read(self, n):
            File.asked += n
            return Counted(super().read(n))

    data = b"\0Habc" * 20_000
    assert len(list(git_log.records(File(data), 0, len(data)))) == 20_000
    assert Counted.copied < 4 * len(data)
    File.asked = 0
    assert len(list(git_log.records(File(data), 0, 1000))) == 200 and File.asked < 4000


def test_many_ranges_are_few_tasks(tmp_path):
    (tmp_path / "a").write_bytes(b"\0Habc" * 20_000)
    found = git_log.GitLogReader({"path": str(tmp_path), "splitbytes": "64"}, None).partitions()
    assert len(found) <= git_log.TASKS
    assert [r for p in found for r in p.found] == [(str(tmp_path / "a"), at, min(at + 64, 100_000)) for at in range(0, 100_000, 64)]
