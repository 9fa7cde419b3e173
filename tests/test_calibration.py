"""The calibration packer against one that goes row by row."""

import hashlib

import pytest

from corpusloom.operators import calibration, groups
from corpusloom.sources import tables
from test_size import most_rows

EOS = 3


def coder():
    """Functions that are sent to workers, which don't have this module: made here, they go by value."""

    def encode(texts):
        return [[ord(c) for c in t] for t in texts]

    def decode(lists):
        return ["".join(map(chr, x)) for x in lists]

    return encode, decode


encode, decode = coder()


def brute(data, size, count):
    """Windows and selected ids."""
    stream, ids = [], []
    for i, text in sorted(data, key=lambda x: hashlib.sha256(f"{calibration.TAG}\0{x[0]}".encode()).digest()):
        own = encode([text])[0]
        stream += own if own and own[-1] == EOS else [*own, EOS]
        ids.append(i)
        if len(stream) >= size * count:
            return decode([stream[k * size : (k + 1) * size] for k in range(count)]), ids
    raise ValueError


def data(n=300):
    return [(f"row-{i}", f"text {i} " * (i % 7) + ("\x03" if i % 5 == 0 else "")) for i in range(n)]


def test_windows_equal_brute(spark):
    rows = data()
    df = spark.createDataFrame(rows, "id string, text string").repartition(4)
    for size, count in ((16, 3), (50, 40), (7, 1)):
        made, selected = calibration.windows(df, encode, decode, EOS, size, count)
        texts, ids = brute(rows, size, count)
        assert [r.text for r in made.orderBy("window").collect()] == texts
        assert [r.id for r in selected.orderBy("start").collect()] == ids


def test_only_the_prefix_is_tokenized(spark):
    seen, code = spark.sparkContext.accumulator(0), encode

    def counted(texts):
        seen.add(len(texts))
        return code(texts)

    rows = data(2000)
    found = calibration.prefix(spark.createDataFrame(rows, "id string, text string"), counted, EOS, 500).count()
    assert found == seen.value < 400  # about 24 bytes a row, and the guess of four bytes a token


def test_what_is_refused(spark):
    df = spark.createDataFrame(data(10), "id string, text string")
    for eos in (None, -1, "x", True):
        with pytest.raises(ValueError, match="EOS"):
            calibration.windows(df, encode, decode, eos, 4, 1)
    with pytest.raises(ValueError, match="are required"):
        calibration.windows(df, encode, decode, EOS, 1000, 1000)
    with pytest.raises(Exception, match="invalid ids"):
        calibration.windows(df, lambda texts: [[-1] for _ in texts], decode, EOS, 4, 1)
    with pytest.raises(Exception, match="isn't the same"):
        calibration.windows(df, encode, lambda lists: ["x" for _ in lists], EOS, 4, 1)


def test_publishing(spark, tmp_path):
    kit = tmp_path / "tokenizer"
    kit.mkdir()
    rows = [(i, [("user", t or "nothing"), ("assistant", "yes")]) for i, t in data(60)]
    df = spark.createDataFrame(rows, "id string, messages array<struct<role: string, content: string>>")
    out = f"file://{tmp_path}/out"
    (kit / "tokenizer.json").write_text("{}")
    (kit / "deep").mkdir()
    (kit / "deep" / "chat_template.jinja").write_text("x")
    with pytest.raises(ValueError, match="chat_template.jinja, tokenizer_config.json"):
        calibration.publish(df, f"file://{kit}", encode, decode, EOS, out, 16, 8)
    for n in calibration.TOKENIZER_FILES[1:]:
        (kit / n).write_text(n)
    first, second = calibration.publish(df, f"file://{kit}", encode, decode, EOS, out, 16, 8)
    m = spark.read.parquet(second).collect()
    texts = [r.text for r in spark.read.parquet(first).orderBy("window").collect()]
    assert len(m) == 1 and len(texts) == 8 and all(len(t) == 16 for t in texts)
    as_text = [(i, "\n".join(f"<{r}>{c}" for r, c in ms)) for i, ms in rows]
    want, ids = brute(as_text, 16, 8)
    assert texts == want and m[0].selected == ids and m[0].tokens == 128
    assert m[0].tokenizer["tokenizer.json"] == hashlib.sha256(b"{}").hexdigest() and len(m[0].tokenizer) == 3
    assert m[0].sha256 == hashlib.sha256("".join(hashlib.sha256(t.encode()).hexdigest() for t in texts).encode()).hexdigest()
    with pytest.raises(FileExistsError):
        calibration.publish(df, f"file://{kit}", encode, decode, EOS, out, 16, 8)
    assert not tables.exists(spark, f"{out}2")
    with pytest.raises(ValueError, match="are required"):
        calibration.publish(df, f"file://{kit}", encode, decode, EOS, f"{out}2", 4096, 512)
    assert not tables.exists(spark, f"{out}2") and not tables.exists(spark, f"{out}2.manifest")


def test_a_large_batch_is_cut():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 1000})
    parts = list(calibration.slices([batch, batch.slice(0, 0)], 10_000))
    assert sum(p.num_rows for p in parts) == 1000 and max(p.num_rows for p in parts) <= 10


def test_ids_are_not_moved_one_by_one(spark, monkeypatch):
    """A list goes to its windows in pieces, and texts or all rows aren't written beside the ids."""
    written, kept = {}, tables.saved

    def saved(df, path):
        written[path.rsplit("/", 1)[-1]] = df.columns
        return kept(df, path)

    monkeypatch.setattr(tables, "saved", saved)
    rows = [(f"row-{i}", "x" * 1000) for i in range(50)]
    made, _ = calibration.windows(spark.createDataFrame(rows, "id string, text string"), encode, decode, EOS, 500, 90)
    assert [r.text for r in made.orderBy("window").collect()] == brute(rows, 500, 90)[0]
    assert all("text" not in columns for name, columns in written.items() if name != "windows") and "selected" not in written
    cut = groups.windows(spark.createDataFrame([(list(range(10_000)), 0)], "ids array<int>, start long"), "ids", "start", 1000, 10)
    assert most_rows(cut) == 10


def test_windows_are_cut_where_lists_end(spark):
    """Empty lists, lists of several windows, of a part of one, and what is left over."""
    lengths = [0, 7, 3, 25, 0, 1, 4, 13, 9]
    stream, rows = [], []
    for k, n in enumerate(lengths):
        rows.append((list(range(100 * k, 100 * k + n)), len(stream)))
        stream += rows[-1][0]
    d = spark.createDataFrame(rows, "ids array<int>, start long").repartition(3)
    for size, count in ((5, 12), (10, 3), (1, 62), (62, 1)):
        got = groups.windows(d, "ids", "start", size, count).orderBy("window").collect()
        assert [r.window for r in got] == list(range(count)) and [i for r in got for i in r.ids] == stream[: size * count]
