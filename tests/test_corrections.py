"""Corrections as state against the batch join, in several orders of arrival."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import joins
from corpusloom.streaming import corrections

CANDIDATES = "pos_key string, cycle string, candidate string, order string, at timestamp"
CORRECTIONS = "id string, about string, in_cycle string, pos int, decision string, at timestamp"
FIELDS = "about string, in_cycle string, pos int, decision string"


@pytest.fixture
def stated(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, corrections.PROVIDER)
    yield spark
    spark.conf.set(name, old)


def rows(seed):
    rng = random.Random(seed)
    cands = [{"pos_key": f"p{i}", "cycle": str(i % 3), "candidate": str(i % 5), "order": f"c{i % 3}_{i % 5:02d}", "at": f"2024-01-01T{i % 24:02d}:00:00"} for i in range(24)]
    names = lambda: rng.choice([str(rng.randrange(5)), f"C{rng.randrange(3)}_0{rng.randrange(5)}", f"cc{rng.randrange(3)}_0{rng.randrange(5)}", "n/a", "other"])
    fixes = [{"id": f"k{i}", "about": names(), "in_cycle": rng.choice(["", "", "0", "1"]), "pos": i, "decision": rng.choice(["accept", "reject", ""]), "at": f"2024-01-01T{rng.randrange(24):02d}:30:00"} for i in range(60)]
    return cands, fixes


def streamed(spark, tmp_path, order, name, keep="30 days", late="40 days"):
    """The overlay after batches of (kind, row) lists."""
    for kind in ("c", "k"):
        (tmp_path / name / kind).mkdir(parents=True)
    read = lambda kind, schema: spark.readStream.schema(schema).json(f"file://{tmp_path}/{name}/{kind}")
    for n, part in enumerate(order):
        for kind in ("c", "k"):
            lines = [json.dumps(r) for k, r in part if k == kind]
            if lines:
                (tmp_path / name / kind / f"{n}.json").write_text("\n".join(lines))
        found = corrections.matched(corrections.arrivals(read("c", CANDIDATES), read("k", CORRECTIONS)), late, keep)
        q = found.writeStream.format("parquet").option("path", f"file://{tmp_path}/{name}/out").option("checkpointLocation", f"file://{tmp_path}/{name}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
    out = spark.read.schema(corrections.OUTPUT).parquet(f"file://{tmp_path}/{name}/out")
    return sorted(map(tuple, joins.overlay(corrections.overlay_of(out, FIELDS), ["decision", "about"]).collect()))


def test_every_order_gives_the_batch_result(stated, tmp_path):
    cands, fixes = rows(6)
    both = [("c", r) for r in cands] + [("k", r) for r in fixes]
    c = stated.createDataFrame([tuple(r.values()) for r in cands], CANDIDATES.replace("timestamp", "string"))
    k = stated.createDataFrame([tuple(r.values()) for r in fixes], CORRECTIONS.replace("timestamp", "string"))
    want = sorted(map(tuple, joins.overlay(joins.corrections_for(c, k), ["decision", "about"]).collect()))
    assert len(want) > 5
    rng = random.Random(9)
    mixed = rng.sample(both, len(both))
    orders = {"after": [both[:24], both[24:]], "before": [both[24:], both[:24]], "mixed": [mixed[:13], mixed[13:25], mixed[25:] + mixed[:5]]}  # some rows come again
    for name, order in orders.items():
        assert streamed(stated, tmp_path, order, name) == want, name


def test_state_goes_with_the_watermark(stated, tmp_path):
    cand = {"pos_key": "p", "cycle": "1", "candidate": "7", "order": "x", "at": "2024-01-01T00:00:00"}
    fix = lambda i, about, at: ("k", {"id": i, "about": about, "in_cycle": "", "pos": 1, "decision": "reject", "at": at})
    order = [[("c", cand)], [fix("a", "other", "2024-03-01T00:00:00")], [fix("b", "other", "2024-03-02T00:00:00")], [fix("c", "7", "2024-03-03T00:00:00")]]
    assert streamed(stated, tmp_path, order, "late", keep="1 day", late="1 hour") == []
    assert streamed(stated, tmp_path, order, "kept", keep="90 days", late="1 hour") != []
