"""Documents with awkward rows, for every operator on texts."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, text_2 string, length int"
TEXTS = [
    None, "", "   ", "a", "A b  c\n\n d\te", "<|endoftext|> is text <|startoftext|>x", "it's I'll don't x'tion 12 345", "Éa ß Œuf ª² × ÷", "é à", "日本語 テスト　ok",
    "\x1ca\x1d b \x85 c d", "👩‍👩‍👧 ok", "x" * 3000, "word " * 4000, "one two three four five", "one two three four", " lead and trail ", "line\nline\nother\n", "\r\nA\r\n\r\nB", "a\x00b", "### $$$ %%% &&& *** ||| <<< >>>",
]


def frame(spark, texts=None):
    texts = TEXTS if texts is None else texts
    rows = [(i, t, "en" if i % 2 else None, "src0", None, "clash", 7) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], (None, "no id here", "en", None, 3, None, None)] if rows else []
    return spark.createDataFrame(rows, DOCS)
