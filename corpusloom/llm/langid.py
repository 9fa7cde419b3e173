"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

The network runs over a text's bytes (ASCII in lower case) in windows of WINDOW, so that its state crosses words, and gives
every byte a distribution over the languages; a document's is the mean over its bytes of letters and of characters outside ASCII.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows

#: Bytes of a window, and of a window that the network learns from; windows that are run at once.
WINDOW, LEARNED, AT_ONCE = 128, 32, 2048
HIDDEN = 8
STEPS, BATCH, RATE = 500, 256, 0.02
#: The bound of the labelled sample: so many documents, those of the lowest hashes, none longer than so many characters.
SAMPLE, SAMPLE_CHARS = 2400, 20_000
#: Trainings from other starts, until one misreads no more than one in FEW of the texts that it learned from; the best counts.
TRIES, FEW = 3, 400
UNKNOWN = "und"
LETTER = re.compile(rb"[A-Za-z]")
#: Bytes (in lower case) that a document's distribution is pooled over.
LETTERLIKE = np.zeros(256, np.float32)
LETTERLIKE[97:123] = LETTERLIKE[128:] = 1


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _run(p: dict, side: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) over bytes x (T, B); keep gets what the way back needs."""
    hidden = p["U" + side].shape[0]
    w, u_all, bias = p["W" + side], p["U" + side], p["b" + side]
    h = np.zeros((x.shape[1], hidden), w.dtype)
    out = np.empty((*x.shape, hidden), w.dtype)
    for t in range(len(x)):
        a = w.take(x[t], 0)
        u = h @ u_all
        u += bias
        zr = a[:, : 2 * hidden] + u[:, : 2 * hidden]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r, un = zr[:, :hidden], zr[:, hidden:], u[:, 2 * hidden :]
        n = r * un
        n += a[:, 2 * hidden :]
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((h, z, r, un, n))
        h = h - n
        h *= z
        h += n
        out[t] = h
    return out


def states(p: dict, side: str, x: np.ndarray) -> np.ndarray:
    """The states of _run as (T, H, B): with windows along the last axis all steps are over contiguous rows."""
    hidden = p["U" + side].shape[0]
    w, u_all, bias = np.ascontiguousarray(p["W" + side].T), np.ascontiguousarray(p["U" + side].T), p["b" + side][:, None]
    # sigmoid(x) is (1 + tanh(x / 2)) / 2
    half = np.where(np.arange(3 * hidden) < 2 * hidden, 0.5, 1).astype(w.dtype)[:, None]
    w, u_all, bias = w * half, u_all * half, bias * half
    w[: 2 * hidden] += bias[: 2 * hidden]
    last = bias[2 * hidden :]
    h = np.zeros((hidden, x.shape[1]), w.dtype)
    a, u, zr = np.empty((3 * hidden, x.shape[1]), w.dtype), np.empty((3 * hidden, x.shape[1]), w.dtype), np.empty((2 * hidden, x.shape[1]), w.dtype)
    out = np.empty((len(x), hidden, x.shape[1]), w.dtype)
    for t in range(len(x)):
        np.take(w, x[t], 1, out=a, mode="clip")
        np.matmul(u_all, h, out=u)
        np.add(a[: 2 * hidden], u[: 2 * hidden], out=zr)
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        n = u[2 * hidden :]
        n += last
        n *= zr[hidden:]
        n += a[2 * hidden :]
        np.tanh(n, out=n)
        h = np.subtract(h, n, out=out[t])
        h *= zr[:hidden]
        h += n
    return out


def positions(p: dict, x: np.ndarray) -> np.ndarray:
    """Distribution (T, L, B) over the languages at each byte of windows of one length (T, B)."""
    half = p["Uf"].shape[0]
    s = np.matmul(np.ascontiguousarray(p["O"][:half].T), states(p, "f", x))
    s += np.matmul(np.ascontiguousarray(p["O"][half:].T), states(p, "b", x[::-1]))[::-1]
    s += p["o"][:, None]
    s -= s.max(1, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(1, keepdims=True)
    return s


def gradients(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy per byte and its gradient, by backpropagation through time. y: the language of each window."""
    kept: dict[str, list] = {"f": [], "b": []}
    hidden = p["Uf"].shape[0]
    h = np.concatenate([_run(p, "f", x, kept["f"]), _run(p, "b", x[::-1], kept["b"])[::-1]], 2)
    s = h @ p["O"] + p["o"]
    s = np.exp(s - s.max(2, keepdims=True))
    s /= s.sum(2, keepdims=True)
    total = x.size
    loss = -float(np.log(s[:, np.arange(len(y)), y] + 1e-12).sum()) / total
    s[:, np.arange(len(y)), y] -= 1
    s /= total
    g = {"O": np.tensordot(h, s, ([0, 1], [0, 1])), "o": s.sum((0, 1))}
    dh_all = s @ p["O"].T
    for side in "fb":
        dh_side = dh_all[..., :hidden] if side == "f" else dh_all[::-1, :, hidden:]
        xs = x if side == "f" else x[::-1]
        gw, gu, gb = np.zeros_like(p["W" + side]), np.zeros_like(p["U" + side]), np.zeros_like(p["b" + side])
        carry = np.zeros_like(dh_side[0])
        for t in range(len(x) - 1, -1, -1):
            before, z, r, un, n = kept[side][t]
            d = dh_side[t] + carry
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (before - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            da = np.concatenate([dz, dr, dn], 1)
            du = np.concatenate([dz, dr, dn * r], 1)
            np.add.at(gw, xs[t], da)
            gu += before.T @ du
            gb += du.sum(0)
            carry = d * z + du @ p["U" + side].T
        g |= {"W" + side: gw, "U" + side: gu, "b" + side: gb}
    return loss, g


def train(texts: list[bytes], labels: list[str], seed: int = 7, steps: int = STEPS) -> dict | None:
    """Parameters (and "langs") after Adam over windows from everywhere in the texts; None without labels. Every language counts
    alike, and in a language every byte."""
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    bodies = [b" ".join(t for t, n in zip(texts, labels, strict=True) if n == name).lower() + b" " * LEARNED for name in langs]
    bodies = [np.frombuffer(b, np.uint8) for b in bodies]
    p = {"O": rng.normal(0, 0.3, (2 * HIDDEN, len(langs))), "o": np.zeros(len(langs))}
    for side in "fb":
        p |= {"W" + side: rng.normal(0, 0.3, (256, 3 * HIDDEN)), "U" + side: rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)), "b" + side: np.zeros(3 * HIDDEN)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    each = max(1, BATCH // len(langs))
    y = np.repeat(np.arange(len(langs)), each)
    inside = np.arange(LEARNED)
    for step in range(1, steps + 1):
        x = np.concatenate([b[rng.integers(0, len(b) - LEARNED + 1, each)[:, None] + inside] for b in bodies]).T
        _, g = gradients(p, x, y)
        rate = RATE * (1 - step / (steps + 1))
        for k in p:
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] * g[k] - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p | {"langs": langs}


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of these sizes: each window's text, its start there, and how many of its first bytes the one before has covered.

    A text's last window ends with the text, so it may overlap the one before; a text shorter than a window has one.
    """
    counts = np.maximum(1, -(-sizes // WINDOW))
    text = np.repeat(np.arange(len(sizes)), counts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.minimum(k * WINDOW, np.maximum(0, sizes[text] - WINDOW))
    return text, start, k * WINDOW - start


class Reader:
    """Pools the network's distributions over texts."""

    def __init__(self, p: dict):
        self.langs = p["langs"]
        self.p = {k: v for k, v in p.items() if k != "langs"}

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Sums (text, language) of the distributions at the bytes that are pooled."""
        out = np.zeros((len(texts), len(self.langs)))
        texts = [t.lower() for t in texts]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text, start, seen = windows(sizes)
        room = np.maximum(sizes, WINDOW)
        raw = np.frombuffer(b"".join([t if len(t) >= WINDOW else t.ljust(WINDOW) for t in texts]), np.uint8)
        start = start + (np.cumsum(room) - room)[text]
        inside = np.arange(WINDOW)[:, None]
        for at in range(0, len(text), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            x = raw[start[some] + inside]
            pooled = LETTERLIKE[x] * (inside >= seen[some])
            np.add.at(out, text[some], np.einsum("tlb,tb->bl", positions(self.p, x), pooled))
        return out

    def read(self, texts: list[bytes]) -> list[tuple[str, float]]:
        out = []
        for text, total in zip(texts, self.totals(texts), strict=True):
            if not (LETTER.search(text) or any(map(str.isalpha, text.decode("utf-8", "replace")))) or not total.sum():
                out.append((UNKNOWN, 0.0))
            else:
                k = int(total.argmax())
                out.append((self.langs[k], float(min(1.0, total[k] / total.sum()))))
        return out


def held_out(docs: DataFrame, parts: int = 4, at: int = 2):
    """Whether crc32 of doc_id as text leaves the remainder; false for a null doc_id."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % parts == at, F.lit(False))


def sample(docs: DataFrame) -> list[tuple[bytes, str]]:
    """(text, lang) of the SAMPLE labelled documents of the lowest hashes that aren't held out. Repeated ids count once.

    First the ids, from a share of all hashes that grows until it holds enough, then their texts: the driver gets SAMPLE texts
    and a few ids for each of them, however many rows and partitions there are.
    """
    labelled = docs.where(docs["doc_id"].isNotNull() & docs["lang"].isNotNull() & docs["text"].isNotNull() & ~held_out(docs))
    labelled = labelled.select("doc_id", "lang", F.col("text").cast("binary").alias("text"), F.xxhash64("doc_id").alias("o"))
    share = 4 * SAMPLE / max(1, labelled.count())
    while True:
        some = labelled.where(F.length(F.col("text").cast("string")) <= SAMPLE_CHARS)
        if share < 1:
            some = some.where(F.col("o") < int(2**64 * share) - 2**63)
        ids = some.select("o", "doc_id").distinct().orderBy("o", "doc_id").limit(SAMPLE).collect()
        if len(ids) == SAMPLE or share >= 1:
            break
        share *= 8
    if not ids:
        return []
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in ids], some.select("doc_id").schema)
    found = some.where(F.col("o") <= ids[-1]["o"]).join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("first"))
    return sorted((bytes(r["first"]["text"]), r["first"]["lang"]) for r in found.collect())


def misread(model: dict, texts: list[bytes], labels: list[str]) -> int:
    """How many of the texts a model gives another language than their label."""
    reader = Reader(model)
    return sum(lang != label for at in range(0, len(texts), 200) for (lang, _), label in zip(reader.read(texts[at : at + 200]), labels[at : at + 200], strict=True))


def fit(docs: DataFrame) -> dict | None:
    """Train on the bounded sample of labelled rows that aren't held out. A short training may take a family of alike texts for another
    language, which the sample itself shows: so up to TRIES trainings, of which the one that misreads the fewest of its texts counts."""
    found = sample(docs)
    texts, labels = [t for t, _ in found], [lang for _, lang in found]
    best, least = None, len(texts) + 1
    for seed in range(7, 7 + TRIES):
        model = train(texts, labels, seed)
        if model is None:
            return None
        wrong = misread(model, texts, labels)
        if wrong < least:
            best, least = model, wrong
        if least * FEW <= len(texts):
            break
    return best


def _mark(model: dict) -> str:
    return hashlib.md5(b"".join(v.tobytes() for k, v in sorted(model.items()) if k != "langs")).hexdigest()


def predict(docs: DataFrame, model: dict | None, also: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (and the columns named in also) of every row, from the whole text alone.

    Null text, text without a letter, or no labelled row to learn from: "und" and 0. Repeated rows give repeated rows.
    """
    mark = _mark(model) if model else ""
    also = also or []

    def run(parts):
        from corpusloom.llm.langid import Reader

        reader = rows.kept(("languages", mark), lambda: Reader(model)) if model else None
        for part in parts:
            found = reader.read(part["_text"]) if model else [(UNKNOWN, 0.0)] * len(part["_text"])
            yield {k: part[k] for k in ("doc_id", "held_out", *also)} | {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    rows.prepare(docs.sparkSession)
    chosen = docs.select(docs["doc_id"], held_out(docs).alias("held_out"), *[docs[c] for c in also], rows.text_bytes(docs).alias("_text"))
    schema = chosen.select("doc_id", "held_out", *also).schema.add("lang_pred", "string").add("score", "double")
    return rows.map_rows(chosen, run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """fit() and predict() over one table."""
    return predict(docs, fit(docs))


def known(docs: DataFrame, model: dict | None, min_score: float) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is known with at least min_score. Without a model: none rejected
    but those whose text is null or has no letter."""
    mark = _mark(model) if model else ""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from corpusloom.llm.langid import Reader

        reader = rows.kept(("languages", mark), lambda: Reader(model)) if model else None
        for batch in batches:
            step = max(1, int(batch.num_rows * rows.SLICE_BYTES / max(rows.SLICE_BYTES, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = [t or b"" for t in pc.cast(part.column(part.schema.get_field_index("text")), pa.binary()).to_pylist()]
                if model:
                    keep = [lang != UNKNOWN and score >= min_score for lang, score in reader.read(texts)]
                else:
                    keep = [any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts]
                yield part.filter(pa.array(keep, pa.bool_()))

    rows.prepare(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
