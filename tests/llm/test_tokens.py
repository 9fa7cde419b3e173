import hashlib
import zlib

import numpy as np
import pytest
from cases import frame

from corpusloom.llm import bpe_text, packing, queries, simple8b, token_counts, token_files, tokens
from corpusloom.llm.tokens import vocabulary


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


def docs(spark, sf):
    return [*frame(spark).collect(), *spark.read.parquet(f"{sf}/documents.parquet").collect()]


def le(ids):
    return np.array(ids, "<u4").tobytes()


def test_segment_tree_equals_library(spark, sf):
    t = library("word_bpe_49k.json")
    for df in (frame(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        texts = sorted((str(r.doc_id), r.text or "") for r in df.collect())
        got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_text.digests(df, vocabulary("word_bpe_49k.json")).collect())
        want = []
        for d, x in texts:
            ids = t.encode(x, add_special_tokens=False).ids
            want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert got == sorted(want)


def test_encode_decode_frames(spark):
    path = vocabulary("word_bpe_49k.json")
    df = frame(spark)
    t = library("word_bpe_49k.json")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    ids = bpe_text.encode(df, path)
    for r in ids.collect():
        assert r.ids == t.encode(texts[r.doc_id], add_special_tokens=False).ids
    for r in bpe_text.decode(ids, path).collect():
        assert r.text == t.decode(t.encode(texts[r.doc_id], add_special_tokens=False).ids, skip_special_tokens=False)


def capitals(n=600):
    """Words over Greek, Turkish, Cyrillic and German capitals, Latin letters, combining marks and marks of pieces."""
    rng = np.random.default_rng(11)
    letters = [*"ΟΔΟΣΑΒΓσςΆΈώ", *"İIıŞĞÇ", *"ЖЩЪЁйў", *"ẞßÄÖÜſ", *"AbÉéÇñ", "\u0301", "\u0307", "\u0308", "'", "’", "-", ".", "3", "Ǆ", "ﬁ", "Ω", "K"]
    words = ["".join(rng.choice(letters, rng.integers(1, 8))) for _ in range(4 * n)]
    return ["ΟΔΟΣ", "ΣΑΣ", "ὈΔΥΣΣΕΎΣ ΟΔΟΣ.", "STRASSE ẞ", "İstanbul IĞDIR", *[" ".join(words[i : i + 4]) for i in range(0, len(words), 4)]]


@pytest.mark.parametrize(("kind", "name"), [(tokens.LowerIds, "word_bpe_49k.json"), (tokens.ByteIds, "byte_bpe_50k.json")])
def test_ids_of_capitals(kind, name):
    texts = capitals()
    want = [t.ids for t in library(name).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in kind(vocabulary(name)).ids([t.encode() for t in texts])] == want


def test_capitals_by_other_coders(spark):
    from pyspark.sql import Row

    texts = capitals(200)
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in enumerate(texts)], "doc_id long, text string")
    t = library("word_bpe_49k.json")
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert [r.ids for r in sorted(bpe_text.encode(df, vocabulary("word_bpe_49k.json")).collect(), key=lambda r: r.doc_id)] == want
    got = sorted(tuple(r) for r in token_files.digests(df, vocabulary("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids_crc32").collect())
    assert got == [(i, len(x) + 1, zlib.crc32(le([*x, 2]))) for i, x in enumerate(want)]


@pytest.mark.parametrize("top", [1, 5, 200, 1 << 16, 1 << 31, (1 << 63) + 5])
def test_simple8b_round_trip(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 255, 256, 257, 5000):
        x = rng.integers(0, top, n, dtype=np.uint64)
        x[: n // 3] = rng.integers(0, 3, n // 3)
        words, offsets = simple8b.encode(x)
        assert (simple8b.decode(words, offsets, n) == x).all()
        assert len(words) <= 2 * n


def test_token_files(spark, sf):
    t = library("word_bpe_49k.json")
    for df in (frame(spark), spark.read.parquet(f"{sf}/documents.parquet").repartition(7)):
        rows = sorted(((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in df.collect()))
        at, want = 0, []
        for d, x in rows:
            ids = t.encode(x, add_special_tokens=False).ids + [2]
            want.append((d, at, len(ids), zlib.crc32(le(ids))))
            at += len(ids)
        got = token_files.digests(df, vocabulary("word_bpe_49k.json")).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)


@pytest.mark.parametrize("size", [16, 1024])
def test_packing(spark, sf, size):
    t = library("byte_bpe_50k.json")
    for df in (frame(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        got = packing.pack_documents(df, vocabulary("byte_bpe_50k.json"), size).collect()
        want = []
        for r in df.collect():
            ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
            head = len(ids) % size or size
            cuts = [0, *range(head, len(ids) + 1, size)]
            want += [(str(r.doc_id), k, a, b - a, zlib.crc32(le(ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
        seqs = {}
        for r in got:
            seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for x in seqs.values():
            x.sort()
            assert x[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:], strict=False)) and sum(n for _, n in x) <= size
        total = sum(r.length for r in got)
        assert len(seqs) <= -(-total // size) + max(1, 0.02 * len(seqs))


def test_swaps_empty_bins():
    lengths = np.array([6, 6, 5, 5, 4, 4])
    assert len(packing.swaps([[0, 4], [1, 2][:1], [2, 3], [5]], lengths, 10)) == 3
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 500)
    bins = packing.swaps([[i] for i in range(500)], lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(500)) and max(sum(lengths[i] for i in b) for b in bins) <= 100
    assert len(bins) <= -(-lengths.sum() // 100) * 1.05


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, sf, rule):
    t = library("byte_bpe_50k.json")
    for df in (frame(spark), spark.read.parquet(f"{sf}/documents.parquet").limit(60)):
        got = {}
        for r in token_counts.count(df, vocabulary("byte_bpe_50k.json"), rule).collect():
            got.setdefault(str(r.doc_id), []).append((r.section, r.start, r.end, round(r.n_tokens, 6)))
        for r in df.collect():
            x = r.text or ""
            cuts = [0] + [i + 1 for i, c in enumerate(x) if c == "\n" and i + 1 < len(x)] + [len(x)]
            sections = list(zip(cuts, cuts[1:], strict=False))
            n = [0.0] * len(sections)
            for a, b in t.encode(x, add_special_tokens=False).offsets:
                b = max(b, a + 1)
                over = [max(0, min(b, e) - max(a, s)) for s, e in sections]
                if rule == "share":
                    for k, o in enumerate(over):
                        n[k] += o / (b - a)
                else:
                    n[{"start": next(k for k, o in enumerate(over) if o), "end": max(k for k, o in enumerate(over) if o), "most": over.index(max(over))}[rule]] += 1
            assert sorted(set(got[str(r.doc_id)])) == [(k, s, e, round(m, 6)) for k, ((s, e), m) in enumerate(zip(sections, n, strict=True))]


def test_given_sections(spark):
    df = spark.sql("SELECT 1L doc_id, 'alpha beta gamma' text, array(named_struct('start', 6, 'end', 10)) s UNION ALL SELECT 2L, NULL, NULL")
    got = token_counts.count(df, vocabulary("byte_bpe_50k.json"), "most", "s").collect()
    assert [(r.doc_id, r.section, r.n_tokens) for r in got] == [(1, 0, 1)]


def test_empty_tables(spark):
    none = frame(spark, [])
    for name in ("op5_best_fit_packing", "op6_simple8b_token_files", "op8_token_counts", "op10_bpe_segment_tree"):
        assert name in queries.QUERIES
    assert packing.pack_documents(none, vocabulary("byte_bpe_50k.json")).count() == 0
    assert token_files.digests(none, vocabulary("word_bpe_49k.json")).count() == 0
    assert bpe_text.digests(none, vocabulary("word_bpe_49k.json")).count() == 0
    assert token_counts.count(none, vocabulary("byte_bpe_50k.json")).count() == 0
