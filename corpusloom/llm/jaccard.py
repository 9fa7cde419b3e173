"""Jaccard join of documents on word n-grams by vertical partitioning.

The global order of n-grams is cut into fragments. A fragment has its share of every document's n-grams, finds those that
more than one text has, and passes on only these: a text needs most of its n-grams shared to link with any other. Texts
with one and the same set are one class from the start. Overlaps of two classes are counted in each fragment apart and summed
per pair. Pairs are not listed within a group of classes that are linked already: (1) each n-gram of a prefix names one
leader, the most central class that has it, and every class is compared with its leaders; (2) what is left are pairs of
classes from different components. Of those with one hub (the most central class that both were compared with), only pairs
are looked at that could link by what each shares with the hub, or that have an n-gram in common that the hub lacks: any
other pair overlaps in less than a link needs. So no two classes with a link stay in different components. Then the links of
every class are counted: all pairs of a component's classes are compared, in blocks of classes whose n-grams fit a matrix.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import chunks, rows
from corpusloom.llm.components import components

WORDS, PERCENT = 5, 80
#: N-grams that a task holds before it deals them out; n-grams of a fragment that are aimed at.
FLUSH, FRAGMENT = 1_000_000, 2_000_000
#: Words of a generation whose hashes a worker keeps: a hash is cheap to make again.
HASHED = 100_000
#: Fragments of the order in which the overlaps of a pair are counted.
PARTS = 4
#: N-grams of a block of a component's classes, two of which are compared at a time; columns of a matrix that counts overlaps.
BLOCK, COLUMNS = 65_536, 8192
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
NO_DOC = np.iinfo(np.int64).max


def _final(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text's word hashes; of fewer words, one of the whole sequence."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    width = min(n, words)
    s = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        s = (s ^ hashes[j : n - width + 1 + j]) * _K[j % 5]
        s ^= s >> np.uint64(29)
    s = _final(s)
    s.sort()
    return s if len(s) < 2 else s[np.concatenate([[True], s[1:] != s[:-1]])]


class _Hasher:
    def __init__(self):
        import xxhash

        self.memo = chunks.Memo(lambda words: [xxhash.xxh64_intdigest(w).to_bytes(8, sys.byteorder) for w in words], HASHED)
        #: Of the empty stretch beside white space at a text's ends, which is no word.
        self.none = np.uint64(xxhash.xxh64_intdigest(b""))

    def sets(self, texts: list[bytes], words: int):
        values, index, bounds = self.memo.numbered(chunks.white_split([t.lower() for t in texts]))
        hashes = np.frombuffer(b"".join(values), np.uint64)[index]
        for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            x = hashes[a:b]
            yield shingles(x[x != self.none], words)


def _bits(count: int) -> int:
    """Bits of fragment numbers for so many documents."""
    return max(6, int(np.ceil(np.log2(max(1, count) * 512 / FRAGMENT))))


def _dealt(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """Rows of blobs by fragment: for fragment f >= 0 classes, their numbers of n-grams there, and the n-grams' low 32 bits; for
    -1 - bucket, documents with the size of their set and their class."""

    def run(parts):
        import xxhash

        from corpusloom.llm import jaccard

        hasher = rows.kept("words", jaccard._Hasher)
        held, classes, n_held, seen = [], [], 0, set()
        shift = np.uint64(64 - bits)

        def flush():
            tokens = np.concatenate(held)
            owner = np.repeat(np.arange(len(held), dtype=np.uint32), [len(x) for x in held])
            f = (tokens >> shift).astype(np.uint16 if bits <= 16 else np.uint64)
            order = np.argsort(f, kind="stable")
            f, low, owner = f[order], tokens[order].astype(np.uint32), owner[order]
            cls = np.array(classes, np.uint64)
            cuts = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])).tolist() + [len(f)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                who = owner[a:b]
                first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
                yield {"f": [int(f[a])], "cls": [cls[who[first]].tobytes()], "n": [np.diff(np.append(first, b - a)).astype(np.uint32).tobytes()], "ids": [low[a:b].tobytes()]}

        for part in parts:
            made = list(hasher.sets(part["_text"], words))
            cls = np.array([xxhash.xxh64_intdigest(s.tobytes()) if len(s) else 0 for s in made], np.uint64)
            bucket = (cls >> shift).astype(np.int64)
            doc = np.array([NO_DOC if d is None else d for d in part["doc_id"]], np.int64)
            sizes = np.array([len(s) for s in made], np.uint32)
            for b in np.unique(bucket).tolist():
                at = bucket == b
                yield {"f": [-1 - b], "cls": [cls[at].tobytes()], "n": [sizes[at].tobytes()], "ids": [doc[at].tobytes()]}
            for s, c in zip(made, cls.tolist(), strict=True):
                if len(s) and c not in seen:  # of copies in one task, one
                    seen.add(c)
                    held.append(s)
                    classes.append(c)
                    n_held += len(s)
            if n_held >= FLUSH:
                yield from flush()
                held, classes, n_held = [], [], 0
                if len(seen) > 500_000:
                    seen.clear()
        if held:
            yield from flush()

    return rows.map_rows(docs.select(docs["doc_id"].cast("long").alias("doc_id"), rows.text_bytes(docs).alias("_text")), run, "f long, cls binary, n binary, ids binary")


def _by_key(parts, key):
    """Slices of rows sorted by a key -> (key, {column: list}) with all rows of a key together."""
    now, held = None, None
    for part in parts:
        for i, k in enumerate(part[key]):
            if k != now or held is None:
                if held is not None:
                    yield now, held
                now, held = k, {c: [] for c in part}
            for c in part:
                held[c].append(part[c][i])
    if held is not None:
        yield now, held


def _shared(dealt: DataFrame, bits: int) -> DataFrame:
    """Each fragment's n-grams that at least two classes have, as blobs by bucket of classes, with their frequency on a log scale
    (equal for all classes that have the n-gram); documents pass through to their bucket."""

    def run(parts):
        shift = np.uint64(64 - bits)
        for f, held in _by_key(parts, "f"):
            if f < 0:
                for cls, n, ids in zip(held["cls"], held["n"], held["ids"], strict=True):
                    yield {"bucket": [-1 - f], "f": [-1], "cls": [cls], "n": [n], "ids": [ids], "often": [None]}
                continue
            n = np.frombuffer(b"".join(held["n"]), np.uint32)
            known, which = np.unique(np.frombuffer(b"".join(held["cls"]), np.uint64), return_inverse=True)
            key = (np.frombuffer(b"".join(held["ids"]), np.uint32).astype(np.uint64) << np.uint64(32)) | np.repeat(which.astype(np.uint64), n)
            key.sort()
            if len(key) > 1:
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
            ids = key >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            df = np.diff(np.append(first, len(ids)))
            often = np.minimum(255, np.log2(df) * 8).astype(np.uint8)
            kept = np.repeat(df > 1, df)
            often, ids, cls = np.repeat(often, df)[kept], ids[kept].astype(np.uint32), known[(key[kept] & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            order = np.argsort(cls, kind="stable")
            often, ids, cls = often[order], ids[order], cls[order]
            if not len(cls):
                continue
            bucket = cls >> shift
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist() + [len(cls)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                own = cls[a:b]
                one = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                yield {"bucket": [int(bucket[a])], "f": [f], "cls": [own[one].tobytes()], "n": [np.diff(np.append(one, b - a)).astype(np.uint32).tobytes()], "ids": [ids[a:b].tobytes()], "often": [often[a:b].tobytes()]}

    return rows.map_rows(dealt.repartition("f").sortWithinPartitions("f"), run, "bucket long, f long, cls binary, n binary, ids binary, often binary")


CLASSES = "doc_id long, n long, cls long, rep long, m long, central double, part int, grams array<long>, prefix array<long>"


def _classes(shared: DataFrame, percent: int) -> DataFrame:
    """A row for each document (part null), and PARTS rows for each class that may have a link: grams has its shared n-grams in a
    fragment, prefix (in the first row) those by which it must meet any partner."""

    def run(parts):
        for _, held in _by_key(parts, "bucket"):
            docs = [i for i, f in enumerate(held["f"]) if f < 0]
            grams = [i for i, f in enumerate(held["f"]) if f >= 0]
            doc = np.frombuffer(b"".join([held["ids"][i] for i in docs]), np.int64)
            doc_n = np.frombuffer(b"".join([held["n"][i] for i in docs]), np.uint32).astype(np.int64)
            doc_cls = np.frombuffer(b"".join([held["cls"][i] for i in docs]), np.uint64)
            known, first, which = np.unique(doc_cls, return_index=True, return_inverse=True)
            size = doc_n[first]
            rep = np.full(len(known), NO_DOC)
            np.minimum.at(rep, which, doc)
            yield {
                "doc_id": [None if d == NO_DOC else d for d in doc.tolist()], "n": doc_n.tolist(), "cls": doc_cls.view(np.int64).tolist(), "rep": [None if r == NO_DOC else r for r in rep[which].tolist()],
                "m": [None] * len(doc), "central": [None] * len(doc), "part": [None] * len(doc), "grams": [None] * len(doc), "prefix": [None] * len(doc),
            }
            if not grams:
                continue
            n = np.concatenate([np.frombuffer(held["n"][i], np.uint32) for i in grams])
            cls = np.searchsorted(known, np.frombuffer(b"".join([held["cls"][i] for i in grams]), np.uint64)).astype(np.int64)
            ids = np.concatenate([np.frombuffer(held["ids"][i], np.uint32).astype(np.int64) | (held["f"][i] << 32) for i in grams])
            often = np.frombuffer(b"".join([held["often"][i] for i in grams]), np.uint8)
            cls = np.repeat(cls, n)
            m = np.bincount(cls, minlength=len(known))
            able = (100 * m >= percent * size) & (m > 0)
            kept = able[cls]
            cls, ids, often = cls[kept], ids[kept], often[kept]
            order = np.lexsort((ids, often, cls))
            cls, ids, often = cls[order], ids[order], often[order]
            cuts = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]])).tolist() + [len(cls)] if len(cls) else []
            out = {k: [] for k in ("doc_id", "n", "cls", "rep", "m", "central", "part", "grams", "prefix")}
            for a, b in zip(cuts, cuts[1:], strict=False):
                k = int(cls[a])
                total, mine, own = int(size[k]), int(m[k]), ids[a:b]
                length = total - -(-percent * total // 100) + 1 - (total - mine)  # unshared n-grams come first in the order
                central = float(often[a:b].sum()) / total
                part_of = own % PARTS
                for p in range(PARTS):
                    for name, x in zip(out, (None, total, int(known[k].view(np.int64)), None, mine, central, p, np.sort(own[part_of == p]).tolist(), own[: max(0, length)].tolist() if p == 0 else None), strict=True):
                        out[name].append(x)
            yield out

    return rows.map_rows(shared.repartition("bucket").sortWithinPartitions("bucket"), run, CLASSES)


def _overlaps(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """a, b, na, nb, o of pairs with an overlap: counted in each part apart, then summed per pair."""
    left = grams.select(F.col("cls").alias("a"), "part", F.col("grams").alias("ga"))
    right = grams.select(F.col("cls").alias("b"), "part", F.col("grams").alias("gb"))
    common = pairs.join(left, "a").join(right, ["b", "part"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("o"))
    return common.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))


def _links(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b that may link by their sizes and shared n-grams: columns x, nx, mx, y, ny, my."""
    swap = F.col("x") > F.col("y")
    pick = lambda u, v: F.when(swap, F.col(u)).otherwise(F.col(v))
    able = (100 + percent) * F.least("mx", "my") >= percent * (F.col("nx") + F.col("ny"))
    return pairs.where((F.col("x") != F.col("y")) & able).select(pick("y", "x").alias("a"), pick("x", "y").alias("b"), pick("ny", "nx").alias("na"), pick("nx", "ny").alias("nb")).distinct()


def _side(labelled: DataFrame, s: str) -> DataFrame:
    """One side of a join of labelled classes."""
    names = {"gram": f"gram_{s}", "cls": s, "n": f"n{s}", "m": f"m{s}", "label": f"l{s}", "hub": f"hub_{s}", "with_hub": f"h{s}"}
    return labelled.select(*[F.col(k).alias(v) for k, v in names.items()])


def _beyond_hub(classes: DataFrame, grams: DataFrame, folder: str) -> DataFrame:
    """For each class whose hub's classes are in several components, a row for each n-gram that its hub lacks."""
    several = classes.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("hub")
    open_ = classes.where("cls != hub").join(several, "hub")
    own = open_.join(grams.select(F.col("cls").alias("_c"), "part", F.col("grams").alias("ga")), F.col("cls") == F.col("_c")).drop("_c")
    hub = grams.select(F.col("cls").alias("_h"), F.col("part").alias("_p"), F.col("grams").alias("gb"))
    found = own.join(hub, (F.col("hub") == F.col("_h")) & (F.col("part") == F.col("_p")))
    return rows.saved(found.select("cls", "n", "m", "label", "hub", "with_hub", F.explode(F.array_except("ga", "gb")).alias("gram")), f"{folder}/beyond")


def linked(a, b, percent: int) -> np.ndarray:
    """Which classes of block a link with which of block b (matrix of booleans); a block is sizes and arrays of n-grams."""
    (na, ga), (nb, gb) = a, b
    ids, column = np.unique(np.concatenate([*ga, *gb]), return_inverse=True)
    row = np.repeat(np.arange(len(ga) + len(gb)), [len(x) for x in (*ga, *gb)])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    overlap = np.zeros((len(ga), len(gb)), np.float32)
    for at in range(0, len(ids), COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(ga) + len(gb), min(COLUMNS, len(ids) - at)), np.float32)
        has[row[lo:hi], column[lo:hi] - at] = 1
        overlap += has[: len(ga)] @ has[len(ga) :].T
    o = overlap.astype(np.int64)
    return (o > 0) & (100 * o >= percent * (np.asarray(na)[:, None] + np.asarray(nb)[None, :] - o))


def _block(items: list[dict]):
    """Classes, sizes and n-grams of a block, from its rows (a class has one for each part)."""
    held: dict = {}
    for x in items:
        held.setdefault(x["cls"], (x["n"], []))[1].extend(x["grams"])
    return list(held), [n for n, _ in held.values()], [np.array(g, np.int64) for _, g in held.values()]


def _link_counts(placed: DataFrame, grams: DataFrame, percent: int, folder: str) -> DataFrame:
    """cls, n_links of each class that has links: each pair of blocks of a component is compared once."""
    several = placed.where("n_classes > 1").select(F.col("cls").alias("_cls"), "label", F.ceil(F.col("n_grams") / BLOCK).cast("int").alias("blocks"))
    items = grams.join(several, F.col("cls") == F.col("_cls")).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    blocks = rows.saved(items.groupBy("label", "blocks", "block").agg(F.collect_list(F.struct("cls", "n", "grams")).alias("items")), f"{folder}/blocks")
    left = blocks.select("label", F.col("block").alias("i"), F.col("items").alias("left"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = blocks.where("block > 0").select("label", F.col("block").alias("j"), F.col("items").alias("right"), F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"))
    pairs = left.where("i = j").select("left", F.lit(None).cast(blocks.schema["items"].dataType).alias("right")).unionByName(left.where("i < j").join(right, ["label", "i", "j"]).select("left", "right"))

    def run(parts):
        for part in parts:
            out: dict = {"cls": [], "n_links": []}
            for x, y in zip(part["left"], part["right"], strict=True):
                cls, *a = _block(x)
                other, *b = (cls, *a) if y is None else _block(y)
                found = linked(a, b, percent)
                if y is None:
                    np.fill_diagonal(found, False)
                for names, n in ((cls, found.sum(1)), ([] if y is None else other, found.sum(0))):
                    out["cls"] += names
                    out["n_links"] += n[: len(names)].tolist()
            yield out

    return rows.map_rows(pairs, run, "cls long, n_links long").groupBy("cls").agg(F.sum("n_links").alias("n_links"))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, n_links of each row.

    Texts link when 100 * overlap >= percent * union of their sets. component_id is the smallest doc_id that links reach,
    class_id the smallest with the same set, n_links the number of other sets that link with the row's own. Null, empty or blank text has an empty set, no link, and its own doc_id; a null
    doc_id has the ids of its component's others, if any. Repeated rows give repeated rows; an empty table gives none.

    N-grams are told apart by 64 bits within a text and by 32 bits and the fragment's number between texts.
    """
    return _joined(docs, words, percent, True)


def grouped(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of join without n_links, for callers that need the components alone."""
    return _joined(docs, words, percent, False)


def _joined(docs: DataFrame, words: int, percent: int, count_links: bool) -> DataFrame:
    spark = rows.prepare(docs.sparkSession)
    folder = rows.shared_dir(spark)
    bits = _bits(docs.count())
    found = rows.settled(_classes(_shared(_dealt(docs, words, bits), bits), percent), f"{folder}/classes")
    members = found.where(F.col("part").isNull())
    grams = found.where(F.col("part").isNotNull())
    prefix = rows.saved(grams.where(F.col("part") == 0).select("cls", "n", "m", "central", F.explode("prefix").alias("gram")), f"{folder}/prefix")
    lead = F.max(F.struct(F.col("central").alias("cx"), F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("m").alias("mx")))
    leaders = prefix.groupBy("gram").agg(lead.alias("lead"), F.count("*").alias("all")).where("all > 1").select("gram", "lead.*")
    able = (100 + percent) * F.least("mx", "my") >= percent * (F.col("nx") + F.col("ny"))
    stars = prefix.join(leaders, "gram").select("x", "nx", "mx", "cx", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("m").alias("my"), F.col("central").alias("cy")).where((F.col("x") != F.col("y")) & able).distinct()
    stars = rows.settled(stars, f"{folder}/stars")
    compared = rows.settled(_overlaps(_ordered(stars, percent), grams), f"{folder}/compared")
    first = rows.saved(_links(compared, percent), f"{folder}/links-1")
    labels = components(first, f"{folder}/components-1")
    # each class's hub: the most central class that it was compared with, or itself; and its overlap with the hub
    mine = stars.groupBy(F.col("y").alias("cls")).agg(F.max(F.struct(F.col("cx").alias("c"), F.col("x").alias("hub"))).alias("h"), F.first("cy").alias("cy"))
    mine = mine.where(F.col("h") > F.struct(F.col("cy").alias("c"), F.col("cls").alias("hub"))).select("cls", "h.hub")
    hubs = mine.join(compared, (F.least("cls", "hub") == F.col("a")) & (F.greatest("cls", "hub") == F.col("b"))).select(F.col("cls").alias("_cls"), "hub", F.col("o").alias("with_hub"))
    labelled = prefix.join(labels, prefix["cls"] == labels["node"], "left").select("gram", "cls", "n", "m", F.coalesce("label", "cls").alias("label"))
    open_ = labelled.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("gram")
    labelled = labelled.join(open_, "gram").join(hubs, F.col("cls") == F.col("_cls"), "left").select("gram", "cls", "n", "m", "label", F.coalesce("hub", "cls").alias("hub"), F.coalesce("with_hub", "n").alias("with_hub"))
    labelled = rows.saved(labelled, f"{folder}/open")
    # two classes of a hub link either within what both share with it, or have an n-gram in common that the hub lacks
    within = (100 + percent) * F.least("hx", "hy") >= percent * (F.col("nx") + F.col("ny"))
    by_prefix = _side(labelled, "x").join(_side(labelled, "y"), (F.col("gram_x") == F.col("gram_y")) & (F.col("x") < F.col("y")) & (F.col("lx") != F.col("ly")) & able & ((F.col("hub_x") != F.col("hub_y")) | within))
    beyond = _beyond_hub(labelled.drop("gram").distinct(), grams, folder)
    by_rest = _side(beyond, "x").join(_side(beyond, "y"), (F.col("gram_x") == F.col("gram_y")) & (F.col("hub_x") == F.col("hub_y")) & (F.col("x") < F.col("y")) & (F.col("lx") != F.col("ly")) & able)
    across = _ordered(by_prefix, percent).unionByName(_ordered(by_rest, percent)).distinct()
    across = across.join(compared.select("a", "b"), ["a", "b"], "left_anti")
    second = _links(_overlaps(rows.saved(across, f"{folder}/across"), grams), percent)
    labels = components(first.unionByName(second), f"{folder}/components-2")
    reps = members.where("n > 0").groupBy("cls").agg(F.min("rep").alias("class_id"), F.first("n").alias("_n"))
    placed = reps.join(labels, reps["cls"] == labels["node"], "left").select("cls", "class_id", F.coalesce("label", "cls").alias("label"), "_n")
    least = placed.groupBy("label").agg(F.min("class_id").alias("component_id"), F.count("*").alias("n_classes"), F.sum("_n").alias("n_grams"))
    placed = rows.saved(placed.join(least, "label").select("cls", "label", "class_id", "component_id", "n_classes", "n_grams"), f"{folder}/placed")
    counted = ["n_links"] if count_links else []
    if count_links:
        counts = rows.settled(_link_counts(placed, grams, percent, folder), f"{folder}/counts")
        placed = placed.join(counts, "cls", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    placed = placed.select("cls", "class_id", "component_id", *counted)
    empty = members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), *[F.lit(0).cast("long").alias(c) for c in counted])
    return members.where("n > 0").join(placed, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id", *counted).unionByName(empty)
