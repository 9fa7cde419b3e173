"""Generated files: what is a change, and what a stopped write leaves."""

import pytest

from corpusloom.sources import generated


def lines(spark, *rows):
    return spark.createDataFrame(rows, "k int, value string")


def read(spark, path):
    from pathlib import Path

    folder = Path(generated.current(spark, path).removeprefix("file://"))
    return [x for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]


def test_digest_tells_values_order_and_number(spark):
    base = [(i, f"line {i}") for i in range(300)]
    one = generated.ordered_digest(lines(spark, *base), "k")
    assert generated.ordered_digest(lines(spark, *base[::-1]).repartition(7), "k") == one
    swapped = [(0, "line 1"), (1, "line 0"), *base[2:]]
    for other in (swapped, base[1:], [*base, base[5]], [*base[:-1], (299, None)], [*base[:-1], (None, "line 299")], [(i + 1, t) for i, t in base], []):
        assert generated.ordered_digest(spark.createDataFrame(other, "k int, value string"), "k") != one


def test_versions_of_changes(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    assert generated.current(spark, path) is None
    assert generated.write_if_changed(lines(spark, (2, "b"), (1, "a"), (3, "")), "k", path)
    first = generated.current(spark, path)
    assert read(spark, path) == ["a", "b", ""]
    assert not generated.write_if_changed(lines(spark, (1, "a"), (3, ""), (2, "b")), "k", path) and generated.current(spark, path) == first
    assert generated.write_if_changed(lines(spark, (1, "b"), (2, "a"), (3, "")), "k", path)
    assert read(spark, path) == ["b", "a", ""] and generated.current(spark, path) != first
    assert generated.write_if_changed(spark.createDataFrame([], "k int, value string"), "k", path) and read(spark, path) == []
    assert not generated.write_if_changed(spark.createDataFrame([], "k int, value string"), "k", path)


def test_a_stopped_write_leaves_the_old_version(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    generated.write_if_changed(lines(spark, (1, "a")), "k", path)
    from pyspark.sql import functions as F

    bad = lines(spark, (1, "b")).withColumn("value", F.raise_error(F.lit("stopped")).cast("string"))
    with pytest.raises(Exception, match="stopped"):
        generated.write_if_changed(bad, "k", path)
    assert read(spark, path) == ["a"]
    with pytest.raises(Exception, match="several lines"):
        generated.write_if_changed(lines(spark, (1, "b\nc")), "k", path)
