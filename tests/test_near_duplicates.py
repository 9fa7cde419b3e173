"""Clusters against all pairs."""

import random
from collections import defaultdict

from corpusloom.operators import near_duplicates
from corpusloom.sources import tables


def sets_of(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(data):
    """Links between different sets, and clusters."""
    s = {i: sets_of(t) for i, t in data}
    found = [(a, b) for a in s for b in s if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    label = {i: i for i in s}
    moved = True
    while moved:
        moved = False
        for a, b in found:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                moved = True
    return found, label


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    out = []
    for _ in range(n):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 6)):  # copies with more and more changes, around the threshold
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 40)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out + [None, "", "   ", "one two", "One  TWO", "one two three four five six"]


def test_recall_and_precision(spark):
    data = list(enumerate(texts(3, 80)))
    pairs, label = brute(data)
    got = {r.id: r.cluster for r in near_duplicates.clusters(spark.createDataFrame(data, "id long, text string").repartition(3), "id", "text").collect()}
    assert len(pairs) > 100 and len(got) == len(data)
    met = sum(got[a] == got[b] for a, b in pairs)
    assert met >= 0.99 * len(pairs)
    assert all(label[i] == label[c] for i, c in got.items())  # nothing is in a cluster that links don't make


def test_no_row_is_cut_without_a_link(spark):
    data = list(enumerate(texts(5, 40)))
    rows = [(i, t, "won" if i % 3 else "lost") for i, t in data]
    kept = {r.id for r in near_duplicates.capped_near_duplicates(spark.createDataFrame(rows, "id long, text string, outcome string"), "id", "text", ["outcome"], 2).collect()}
    _, label = brute(data)
    groups = defaultdict(list)
    for i, _, outcome in rows:
        groups[label[i], outcome].append(i)
    assert kept == {i for g in groups.values() for i in sorted(g)[:2]}


def test_a_bucket_that_all_share(spark):
    """One leader is unlike the rest, and many rows share a bucket."""
    base = [f"w{i}" for i in range(200)]
    data = [(i, " ".join(base[: 170 + i % 30])) for i in range(90)] + [(100, " ".join(base[:60]))]
    _, label = brute(data)
    got = {r.id: r.cluster for r in near_duplicates.clusters(spark.createDataFrame(data, "id long, text string"), "id", "text").collect()}
    assert got == label


def test_empty(spark):
    assert near_duplicates.clusters(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0


def test_the_last_row_of_a_lost_cycle_stays(spark):
    data = [(i, "c", "lost", "a", "1", "no", "train") for i in range(20)] + [(i, f"d{i}", "lost", "a", "2", "no", "train") for i in range(30, 50)] + [(i, f"e{i}", "won", "a", "3", "yes", "train") for i in range(60, 80)] + [(99, "c", "lost", "a", "1", "no", "test"), (98, "c", "lost", "a", "1", "no", None)]
    df = spark.createDataFrame(data, "id int, cluster string, outcome string, campaign string, cycle string, won string, assigned_split string")
    from pyspark.sql import functions as F

    got = sorted(r.id for r in near_duplicates.training_sample(df, "id", "cluster", ["outcome"], ["campaign", "cycle"], "id", F.col("won") == "yes").collect())
    assert got == sorted([0, 1, 19, *range(30, 37), 49, *range(60, 80), 98, 99])


def test_sets_are_made_for_texts_with_a_neighbour_alone(spark, monkeypatch):
    """Of 300 texts two are alike; no other's shingles are written or shuffled."""
    rng = random.Random(11)
    data = [(i, " ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(40))) for i in range(299)]
    data.append((299, data[7][1] + " more"))
    written = {}
    kept = tables.saved

    def saved(df, path):
        out = kept(df, path)
        written[path.rsplit("/", 1)[-1]] = out
        return out

    monkeypatch.setattr(tables, "saved", saved)
    got = {r.id: r.cluster for r in near_duplicates.clusters(spark.createDataFrame(data, "id long, text string"), "id", "text").collect()}
    assert got == {i: 7 if i == 299 else i for i in range(300)}
    assert [n for n, df in written.items() if "shingles" in df.columns] == ["sets"] and written["sets"].count() == 2


def test_signatures_do_not_depend_on_how_sets_are_cut(spark, monkeypatch):
    """One set at a time and all at once, with empty texts between; as large a share of min-hashes agrees as of the sets."""
    rows = spark.createDataFrame(list(enumerate(texts(9, 30))), "id long, text string").coalesce(1)
    sets = near_duplicates.shingle_sets(rows, "id", "text")
    want = sorted(map(tuple, near_duplicates.signed(sets).collect()))
    monkeypatch.setattr(near_duplicates, "CHUNK", 1)
    assert sorted(map(tuple, near_duplicates.signed(sets).collect())) == want
    assert sum(r[1] is None for r in want) == 3 and all(len(r[3]) == near_duplicates.BANDS for r in want if r[1])
    two = spark.createDataFrame([(0, list(range(0, 3000))), (1, list(range(1000, 4000)))], "id int, shingles array<long>")
    a, b = [r.buckets for r in near_duplicates.signed(two, 2000, 1).orderBy("id").collect()]
    assert 0.46 < sum(x == y for x, y in zip(a, b, strict=True)) / 2000 < 0.54


def test_links_that_no_bucket_proposes(spark, monkeypatch):
    """One band of so many rows that next to no pair shares a bucket; then one counter and blocks of one component."""
    data = list(enumerate(texts(21, 60)))
    df = spark.createDataFrame(data, "id long, text string").repartition(3)
    pairs, label = brute(data)
    assert len(pairs) > 80
    run = lambda **more: {r.id: r.cluster for r in near_duplicates.clusters(df, "id", "text", **more).collect()}
    assert run(bands=1, per=64, leaders=1) == label and run() == label
    monkeypatch.setattr(near_duplicates.counted, "__defaults__", (1,))
    monkeypatch.setattr(near_duplicates.crossing, "__defaults__", (1,))
    assert run(bands=1, per=64) == label


def test_pairs_that_prefixes_propose_hold_all_links(spark):
    """All pairs at the threshold and above, of small sets too, and no pair of one component."""
    rng = random.Random(4)
    sets = {i: sorted(rng.sample(range(40), n)) for i, n in enumerate([*range(1, 31)] * 4)}
    for i in range(120, 240):
        own = sets[i - 120][rng.randrange(2) :]
        sets[i] = sorted(own + rng.sample(range(40, 80), rng.randrange(3))) or [i]
    df = spark.createDataFrame(list(sets.items()), "id long, shingles array<long>")
    for percent in (50, 80, 100):
        found = near_duplicates.prefixes(df, near_duplicates.counted(df), percent).collect()
        rows = [(r.id, r.id % 5 if parted else r.id, len(sets[r.id]), pos, t) for parted in (False, True) for r in found for pos, t in enumerate(r.tokens)]
        half = len(rows) // 2
        for own, comp in ((rows[:half], lambda i: i), (rows[half:], lambda i: i % 5)):
            got = {(min(r), max(r)) for r in near_duplicates.crossing(spark.createDataFrame(own, "no long, comp long, size int, pos int, token long"), percent, 7).collect()}
            alike = {(a, b) for a in sets for b in sets if a < b and comp(a) != comp(b) and 100 * len(set(sets[a]) & set(sets[b])) >= percent * len(set(sets[a]) | set(sets[b]))}
            assert alike <= got and all(comp(a) != comp(b) for a, b in got)
