import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import frame
from oracle import compare

from corpusloom.llm import collocations, queries, spelling, suffix_blocks, suffix_dedup

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def ascii_lower(s):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), s)


# --- spelling variants


def brute_words(data):
    n = Counter()
    for doc_id, text in data:
        for w in RUN.findall(text or ""):
            w = ascii_lower(w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(data):
    n = brute_words(data)
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    best = {w: min(x, key=lambda y: (-n[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form.get(w) or "", n[form[w]] if w in form else -1, root(w)) for w in n)


def got_variants(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", -1 if r.form_n is None else r.form_n, r.root) for r in spelling.variants(df).collect())


def test_variants_of_a_corpus(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").limit(100)
    data = [(r.doc_id, r.text) for r in df.collect()]
    want = brute_variants(data)
    assert len(want) > 300 and any(w[3] for w in want)
    assert got_variants(spark.createDataFrame(data, "doc_id long, text string").repartition(3)) == want


def test_variants_awkward(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH", 3)
    chain = ["aaaaa " * 3, "aaaab " * 6, "aaabb " * 12, "aabbb " * 30, "abbbb " * 61, "bbbbb " * 200]  # forms lead on from word to word
    more = ["letter lettre lettters leters letterz " * 3, "ÀÉÎõü àéîõü Àéîõü ÀÉÎõ÷ " * 4, "Straße strasse Straße " * 5, "tie_one tieeone tieoone", "ab abc abcd abcde abcde abcde", "naïve’s naïve naïve naïve", "日本語word日本語word語word", "x" * 60 + " " + "x" * 61, None, ""]
    data = [(i, t) for i, t in enumerate(chain + more)] + [(None, "nowhere nowhere nowhere nowhera")] * 3 + [(7, more[1])] * 2
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in data], "doc_id long, text string, word string, n int, root long")
    assert got_variants(df) == brute_variants(data)
    for f in (frame(spark), frame(spark, [])):
        assert got_variants(f) == brute_variants([(r.doc_id, r.text) for r in f.collect()])


def test_long_text_counts_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONG", 10)
    data = [(i, "counted words counted words counted here here here") for i in range(40)]
    assert got_variants(spark.createDataFrame(data, "doc_id long, text string")) == brute_variants(data)


def test_slip():
    for doc_id in (None, 3, -5):
        for w in ("straße", "àb", "x"):
            for every in (1, 97):
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
                want = w if h % every else w[: h % len(w)] + w[h % len(w) + 1 :]
                assert spelling.slip(doc_id, w.encode(), every) == want.encode()


# --- suffix arrays of repeated strings


def brute_removed(data, length=100):
    """Rows (doc_id, text) in; one document for each different pair; the order of several texts of an id is that of the operator."""
    docs = sorted({(i if i is not None else suffix_dedup.LAST, h, (t or "").encode()): i for i, t, h in data})
    first: dict = {}
    gone = {}
    for n, (_, _, t) in enumerate(docs):
        cover = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if first.setdefault(t[p : p + length], (n, p)) != (n, p):
                cover[p : p + length] = True
        gone[docs[n]] = cover
    out = []
    for i, text, h in data:
        t = (text or "").encode()
        cover = gone[i if i is not None else suffix_dedup.LAST, h, t]
        n_spans = int(np.count_nonzero(np.diff(np.concatenate([[False], cover]).astype(int)) == 1))
        kept = bytes(b for b, c in zip(t, cover, strict=True) if not c)
        out.append((-1 if i is None else i, len(t), int(cover.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def check_removed(df):
    from pyspark.sql import functions as F

    data = [(r[0], r[1], r[2]) for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary"))).collect()]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduplicated(df).collect())
    assert got == brute_removed(data)
    return sum(x[2] for x in got)


def repeated_texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(6)] + ["ab" * 130, "z" * 350]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice(["", " "]).join(parts))
    return texts + rng.choices(texts, k=n // 5)


@pytest.mark.parametrize("hot", [3, 1 << 30])
def test_removed_brute(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
    monkeypatch.setattr(suffix_dedup, "SENT", 20)
    data = [(i * 7 % 101, t, "clash", 1) for i, t in enumerate(repeated_texts(hot, 120))]
    data += [data[3], data[3], (None, data[5][1], "x", 2), (None, data[5][1], "x", 2), (None, None, None, None), (9, "", "", 3), (1, data[8][1] * 3, "", 4)]
    assert check_removed(spark.createDataFrame(data, "doc_id long, text string, key string, start int").repartition(5)) > 1000


def test_removed_awkward(spark, sf):
    check_removed(frame(spark))
    assert suffix_dedup.deduplicated(frame(spark, [])).count() == 0
    assert check_removed(spark.read.parquet(f"{sf}/documents.parquet")) > 0


def test_cover_meets_every_difference():
    assert sorted((a - b) % suffix_blocks.PERIOD for a in suffix_blocks.COVER for b in suffix_blocks.COVER if a != b) == list(range(1, suffix_blocks.PERIOD))


@pytest.mark.parametrize("bucket", [4, 200, 1 << 17])
def test_block_order(monkeypatch, bucket):
    monkeypatch.setattr(suffix_blocks, "BUCKET", bucket)
    text = "|".join(repeated_texts(bucket, 30)).encode()
    block, places = suffix_blocks.Block(text), np.arange(len(text))
    order = np.concatenate([block.sorted_bucket(b)[0] for b in block.buckets(places)])
    padded = text + bytes(400)
    depth = [padded[p : p + 100] for p in order.tolist()]
    assert sorted(order.tolist()) == places.tolist() and depth == sorted(depth)


# --- collocations


def brute_intervals(ids, valid, k):
    return Counter(tuple(ids[i : i + k]) for i in range(len(ids)) if valid[i] >= k)


def test_intervals():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 7, 300):
        ids = rng.integers(0, 4, n)
        valid = collocations.room(ids > 0)
        for most in (2, 3, 5, 7):
            found = {k: {tuple(ids[a : a + k].tolist()): c for a, c in zip(at.tolist(), c.tolist(), strict=True)} for k, at, c in collocations.intervals(ids, valid, 2, most)}
            for k in range(2, most + 1):
                assert found.get(k, {}) == brute_intervals(ids.tolist(), valid.tolist(), k)


def brute_collocations(data, least, first, percent=100):
    langs: dict = {}
    for lang, text in data:
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text or "")):
            langs.setdefault("und" if lang is None else lang, []).append(re.findall("[^ \t]+", piece))
    out = []
    for lang, pieces in langs.items():
        n = sum(map(len, pieces))
        f = Counter(tuple(w[i : i + k]) for w in pieces for k in range(1, 6) for i in range(len(w) - k + 1))
        held = {p: c for p, c in f.items() if c >= least and len(p) > 1}
        rows_ = []
        for p, a in held.items():
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * c >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in held.items()):
                rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right, n) in enumerate(sorted(rows_)[:first], 1)]
    return sorted(out)


def got_collocations(df, **more):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mine(df, **more).collect())


@pytest.mark.parametrize("small", [True, False])
def test_collocations_brute(spark, sf, monkeypatch, small):
    if small:
        monkeypatch.setattr(collocations, "SHARD", 50)
        monkeypatch.setattr(collocations, "LONG", 40)
    rng = random.Random(4)
    names = ["New", "york", "city", "a\x1cb", "the", "of", "É", "é", "in the", "big\tcity", "kick", "the,bucket"]
    data = [(rng.choice(["en", "fr", None, "und"]), rng.choice([" ", "  "]).join(rng.choices(names, k=rng.randint(0, 60))) + rng.choice([".", "!x", "\n", ""])) for _ in range(150)]
    data += [("xx", None), ("yy", ""), ("zz", "one two"), ("en", "all alone without any stop " * 300)] + [data[0]] * 3
    df = spark.createDataFrame([(i, t, lang, "clash", 1) for i, (lang, t) in enumerate(data)], "doc_id long, text string, lang string, phrase string, n int").repartition(4)
    for least, first, percent in ((3, 5, 100), (5, 2000, 60)):
        want = brute_collocations(data, least, first, percent)
        assert len(want) > 10 and got_collocations(df, least=least, first=first, percent=percent) == want
    for f in (frame(spark), frame(spark, [])):
        assert got_collocations(f, least=2) == brute_collocations([(r.lang, r.text) for r in f.collect()], 2, 2000)


def test_collocations_equal_sql(spark, sf):
    assert compare(spark, sf, queries.QUERIES["op11_phrase_collocations"], queries.ORACLES["op11_phrase_collocations"]) > 0


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([("en", 1, "a", 3 * 10**15), ("en", 1, "b", 2 * 10**15), ("en", 2, "a b", 10**15 + 7)], "lang string, k int, phrase string, f long")
    n = 9 * 10**15 + 1
    got = collocations.scored(big, spark.createDataFrame([("en", n)], "lang string, n long")).collect()[0]
    assert got.low.score == 1000 * (10**15 + 7) * n // (6 * 10**30)


def test_collocations_shuffle_words_not_phrases(spark, monkeypatch):
    """All pairs are frequent and most longer phrases aren't: what leaves the shards is counted, and is bounded by the words."""
    made, whole = [], collocations.rows.map_rows
    monkeypatch.setattr(collocations.rows, "map_rows", lambda *a: made.append(whole(*a)) or made[-1])
    rng = random.Random(8)
    data = [("en", " ".join(rng.choices("abcdefgh", k=400))) for _ in range(20)]
    df = spark.createDataFrame(data, "lang string, text string").coalesce(1)
    assert got_collocations(df, least=20) == brute_collocations(data, 20, 2000)
    listed = [f.selectExpr("sum(m)" if "m" in f.columns else "count(*)").first()[0] for f in made]
    assert len(listed) == 3 and max(listed) <= 20 * 400


@pytest.mark.parametrize("hot", [10, 200, 1 << 30])
def test_collocations_in_many_ranges(spark, monkeypatch, hot):
    monkeypatch.setattr(collocations, "SHARD", 200)
    monkeypatch.setattr(collocations, "RANGE", 150)
    monkeypatch.setattr(collocations, "HOT", hot)
    rng = random.Random(hot)
    data = [(rng.choice(["en", None]), " ".join(rng.choices(["the", "of", "a", "b", "c", "d.", "e", f"w{rng.randint(0, 99)}"], [30, 20, 3, 3, 3, 3, 3, 3], k=rng.randint(1, 60)))) for _ in range(120)] + [("en", "of the " * 300)] * 3
    df = spark.createDataFrame(data, "lang string, text string").repartition(3)
    want = brute_collocations(data, 4, 2000)
    assert len(want) > 50 and got_collocations(df, least=4) == want


def test_collocation_blocks():
    rng = np.random.default_rng(2)
    for n, parts in ((0, 1), (1, 1), (500, 3)):
        signed = rng.integers(0, 6, n).astype("<i4")
        signed[rng.random(n) < 0.1] *= -1
        own = np.array([0, 5, 1 << 20, 0, 70_000, 3])[np.abs(signed)]
        valid = np.where(signed > 0, collocations.room(own > 0), 0)
        found, times = collocations.suffixes(signed, np.array([0, 5, 1 << 20, 0, 70_000, 3]), 5)
        assert times.sum() == (valid >= 2).sum()
        for hot in ([], [5, 70_000]):
            got = Counter()
            for _, rows_, m in collocations.dealt(found, times, np.array(hot, np.int64), parts):
                columns, again = collocations.unpacked(collocations.packed(rows_, m), len(m), 5)
                assert (columns == rows_.T).all() and (again == m).all()
                for _, ids, f in collocations.frequent(columns, again, 1):
                    got += Counter(dict(zip(map(tuple, ids.tolist()), f.tolist(), strict=True)))
            assert got == sum((brute_intervals(own.tolist(), valid.tolist(), k) for k in range(2, 6)), Counter())
