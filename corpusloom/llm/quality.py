"""Quality rules by distribution divergence, in DataFrame operations only.

A language's references are the shares of character classes in its texts and the shares of its common words among all of its
words. A text with enough words is rejected where the Jensen-Shannon distance of its own shares from those of its language
is too large. Everything about one text is computed in its row; only sums by language and word are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows

#: White space between words, and the symbols that are counted (fixed values of the contract).
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Words shorter than this in code points can be common words; those with this share of a language's words are.
COMMON_CHARS, COMMON_SHARE = 6, 0.005
#: Languages with so many texts have a reference of classes, and with so many words one of common words (at COMMON_SHARE, seen
#: ten times); the rows of others, and of no language, are judged by the base rules alone.
MIN_TEXTS, REFERENCE_WORDS = 10, 2000
#: Languages whose references are sent to every task; of more, the references are joined by a shuffle, dealt to SALTS places.
SENT_LANGUAGES, SALTS = 1000, 64
#: Texts with fewer words are not judged by distance.
GUARD_WORDS = 50
#: The word distance of a text of one repeated common word or symbol is above MAX_WORD_DISTANCE; that of a text without any isn't.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.50
#: So the common words of letters alone are judged apart, as '|' of junk rows can be a common word. Clean texts of n words stay
#: below LETTER_BASE + LETTER_NOISE / sqrt(n); the limit is never above this part of the distance of a text without common words,
#: and holds where a text of its length would have EXPECTED_COMMON of them.
LETTERS = r"^[\p{L}\p{M}]+$"
LETTER_BASE, LETTER_NOISE, LETTER_PART, EXPECTED_COMMON = 0.10, 1.3, 0.95, 7
CLASSES = ("lower", "upper", "digit", "space", "symbol", "mark", "other")
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_MARK = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in SYMBOLS)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measured(docs: DataFrame, also: list[str] | None = None) -> DataFrame:
    """doc_id, lang and the columns in also, with _words, _classes (counts) and the base figures of each whole text."""
    spark_text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    d = docs.select(docs["doc_id"], docs["lang"].cast("string").alias("_lang"), *[docs[c] for c in also or []], spark_text.alias("_text"))
    trimmed = F.trim("_text", F.lit(SPACE))
    d = d.withColumn("_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")))
    left = F.col("_text")
    for name, chars in zip(CLASSES, (_LOWER, _UPPER, _DIGIT, SPACE, SYMBOLS, _MARK), strict=False):
        d = d.withColumn(f"_left_{name}", _without(left, chars)).withColumn(f"_n_{name}", F.length(left) - F.length(F.col(f"_left_{name}")))
        left = F.col(f"_left_{name}")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    d = d.withColumns({
        "_classes": F.array(*[F.col(f"_n_{c}") for c in CLASSES[:-1]], F.length(left)),
        "n_words": F.size("_words").cast("long"),
        "word_chars": (F.length("_text") - F.col("_n_space")).cast("long"),
        "n_symbols": F.col("_n_symbol").cast("long"),
        "_lines": lines,
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop(*[f"_left_{c}" for c in CLASSES[:-1]], *[f"_n_{c}" for c in CLASSES[:-1]])
    # hashes of 2, 4 and 8 words from those of half as many: no slice is made for each word
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    for step in (1, 2, 4):
        n = F.size("_hashes")
        ahead = F.zip_with(F.slice("_hashes", 1, n - step), F.slice("_hashes", 1 + step, n - step), lambda a, b: F.xxhash64(a, b))
        d = d.withColumn("_hashes", F.when(n > step, ahead).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumnRenamed("_hashes", "_windows")
    again = F.size("_windows") > F.size(F.array_distinct("_windows"))
    d = d.withColumn("_sorted", F.when(again, F.array_sort(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_windows")
    m = F.size("_sorted")
    same = F.zip_with(F.slice("_sorted", 1, m - 1), F.slice("_sorted", 2, m - 1), lambda a, b: a["x"] == b["x"])
    d = d.withColumn("_same", F.when(F.col("_sorted").isNotNull(), same))
    no = F.array(F.lit(False))
    places = F.array_sort(F.array_compact(F.zip_with("_sorted", F.zip_with(F.concat("_same", no), F.concat(no, "_same"), lambda a, b: a | b), lambda s, f: F.when(f, s["i"]))))
    d = d.withColumn("_places", F.when(F.col("_sorted").isNotNull(), places)).drop("_sorted", "_same")
    covered = F.aggregate(F.zip_with("_places", F.slice("_places", 2, F.greatest(F.size("_places") - 1, F.lit(0))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_places").isNotNull(), covered), F.lit(0)).cast("long")).drop("_places")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def languages(docs: DataFrame) -> DataFrame:
    """_of: the languages with at least MIN_TEXTS texts that aren't blank."""
    found = docs.select(docs["lang"].cast("string").alias("_of"), F.trim(docs["text"].cast("string"), F.lit(SPACE)).alias("_text")).where("_of is not null and _text != ''")
    return found.groupBy("_of").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_TEXTS).select("_of")


def common_words(docs: DataFrame, known: DataFrame) -> DataFrame:
    """lang, common array<struct<word, share, letters>> of the known languages with enough words: at most 1/COMMON_SHARE words each."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    words = docs.select(docs["lang"].cast("string").alias("lang"), F.explode(F.split(F.lower(text), "[ \\t\\n\\x0B\\f\\r]+")).alias("word")).where(F.col("word") != "")
    # long words are counted as one, so that what is shuffled doesn't grow with the vocabulary
    words = words.groupBy("lang", F.when(F.length("word") < COMMON_CHARS, F.col("word")).alias("word")).agg(F.count("*").alias("n"))
    words = rows.saved(words, rows.shared_dir(docs.sparkSession))
    # a language's sum and words stay apart from the word rows, of which one language may have most
    sums = words.groupBy(F.col("lang").alias("_of")).agg(F.sum("n").alias("all")).where(F.col("all") >= REFERENCE_WORDS).join(known, "_of", "left_semi")
    common = _beside(words.where(F.col("word").isNotNull()), sums.withColumn("_lang", F.col("_of")), "lang", "inner").where(F.col("n") >= COMMON_SHARE * F.col("all")).withColumnRenamed("_lang", "_of")
    found = common.groupBy("_of").agg(F.array_sort(F.collect_list(F.struct((-(F.col("n") / F.col("all"))).alias("less"), "word"))).alias("found"))
    return found.select(F.col("_of").alias("lang"), F.transform("found", lambda f: F.struct(f["word"].alias("word"), (-f["less"]).alias("share"), F.rlike(f["word"], F.lit(LETTERS)).alias("letters"))).alias("common"))


def class_shares(measured_: DataFrame, known: DataFrame) -> DataFrame:
    """lang, classes array<double>: shares of the character classes in the texts of each known language."""
    sums = [F.sum(F.get("_classes", F.lit(i)).cast("long")).alias(c) for i, c in enumerate(CLASSES)]
    own = measured_.groupBy(F.col("_lang").alias("_of")).agg(*sums).join(known, "_of", "left_semi")
    size = F.greatest(F.lit(1.0), sum(F.col(c).cast("double") for c in CLASSES))
    return own.select(F.col("_of").alias("lang"), F.array(*[F.col(c) / size for c in CLASSES]).alias("classes"))


def _term(p: Column, q: Column) -> Column:
    """One class's part of the Jensen-Shannon divergence in bits."""
    m = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2


def _distance(p: Column, q: Column) -> Column:
    sum_ = F.aggregate(F.zip_with(p, q, _term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.when(sum_ < 0, 0.0).otherwise(sum_))


def judged(docs: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Base figures, class_distance, word_distance, letter_distance, base_failed and kept of each row.

    Null or blank text has no words and fails the base rule. Without a reference of its language (a null lang, or one
    of few texts) a row has null distances and is judged by the base rules alone; it never gets a mixed reference. Texts with fewer than GUARD_WORDS words pass the distances. Repeated rows give repeated rows; an empty table gives none.
    """
    folder = rows.shared_dir(docs.sparkSession)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    rest = lambda a: F.concat(a, F.array(F.greatest(F.lit(0.0), 1 - total(a))))
    known = rows.saved(languages(docs), f"{folder}/languages")
    m = _with_own(measured(docs, also), rows.saved(common_words(docs, known), f"{folder}/common"), "common")
    m = m.withColumns({"_common": F.col("_own"), "_pad": F.concat(F.lit(" "), F.lower(F.array_join("_words", "  ")), F.lit(" "))}).drop("_own", "_words")
    # shares of common words, found as bytes between spaces
    left = F.transform("_common", lambda c: F.octet_length(F.replace(F.col("_pad"), F.concat(F.lit(" "), c["word"], F.lit(" ")), F.lit(""))))
    m = m.withColumns({"_left": left, "_size": F.octet_length("_pad")}).drop("_pad")
    shares = F.zip_with("_common", "_left", lambda c, x: (F.col("_size") - x) / (F.octet_length(c["word"]) + 2) / F.greatest(F.col("n_words"), F.lit(1)))
    m = m.withColumns({"_w": shares, "_q": F.transform("_common", lambda c: c["share"])}).drop("_left", "_size")
    lettered = lambda a: F.zip_with(a, "_common", lambda x, c: F.when(c["letters"], x).otherwise(0.0))
    m = m.withColumns({"_lw": lettered("_w"), "_lq": lettered("_q")}).drop("_common").withColumn("_expected", F.col("n_words") * total("_lq"))
    m = m.withColumns({"_none": rest(F.transform("_lq", lambda x: F.lit(0.0))), "_w": rest("_w"), "_q": rest("_q"), "_lw": rest("_lw"), "_lq": rest("_lq")})
    m = m.withColumns({"word_distance": _distance(F.col("_w"), F.col("_q")), "letter_distance": _distance(F.col("_lw"), F.col("_lq")), "_none": _distance(F.col("_none"), F.col("_lq"))})
    limit = F.least(LETTER_BASE + LETTER_NOISE / F.sqrt(F.greatest("n_words", F.lit(1))), LETTER_PART * F.col("_none"))
    m = m.withColumn("_foreign", (F.col("_expected") >= EXPECTED_COMMON) & (F.col("letter_distance") > limit)).drop("_w", "_q", "_lw", "_lq", "_none", "_expected", "_text")
    # written once: the classes' references are sums over it, and a filter on the verdict stays apart from the figures
    m = rows.settled(m, f"{folder}/measured")
    m = _with_own(m, rows.saved(class_shares(m, known), f"{folder}/classes"), "classes")
    size = F.greatest(F.lit(1), F.aggregate("_classes", F.lit(0), lambda s, x: s + x))
    m = m.withColumn("_ref", F.col("_own")).withColumn("_p", F.transform("_classes", lambda x: x / size))
    m = m.withColumn("class_distance", _distance(F.col("_p"), F.col("_ref")))
    over = [F.col("class_distance") > MAX_CLASS_DISTANCE, F.col("word_distance") > MAX_WORD_DISTANCE, F.col("_foreign")]
    far = (F.col("n_words") >= GUARD_WORDS) & F.greatest(*[F.coalesce(x, F.lit(False)) for x in over])
    return m.select("doc_id", *(also or []), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "letter_distance", (~F.col("base_failed") & ~far).alias("kept"))


def _beside(m: DataFrame, refs: DataFrame, lang: str, how: str) -> DataFrame:
    """m with the row of refs whose _of is its language."""
    if refs.count() <= SENT_LANGUAGES:
        return m.join(F.broadcast(refs), F.col(lang) == F.col("_of"), how).drop("_of")
    dealt = refs.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    m = m.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    return m.join(dealt, (F.col(lang) == F.col("_of")) & (F.col("_salt") == F.col("_place")), how).drop("_of", "_salt", "_place")


def _with_own(m: DataFrame, refs: DataFrame, column: str) -> DataFrame:
    """m with the reference of its language as _own, null where it has none."""
    return _beside(m, refs.select(F.col("lang").alias("_of"), F.col(column).alias("_own")), "_lang", "left")
