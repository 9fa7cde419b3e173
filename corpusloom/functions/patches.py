"""Unified diffs as arrays of segments: code filter, pre-image and structural fingerprint, all in the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.ledger import CHIP, stripped

# What ends a line of a patch.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# Paths that count as code.
CODE = "^(?:src/|include/|tests/|bench/|tools/|cmake/|CMakeLists\\.txt)"


def segments(patch: Column) -> Column:
    """array<struct<path, text>> of the files of a patch, by the b/ side of well-formed headers; text ends in one line feed."""
    parts = F.filter(F.split(patch, "(?m)(?=^diff --git )"), lambda s: s.rlike(r"\Adiff --git a/.+? b/.+"))
    return F.transform(parts, lambda s: F.struct(F.regexp_extract(s, r"\Adiff --git a/.+? b/(.+)", 1).alias("path"), F.concat(F.regexp_replace(s, r"(?U)\s+\z", ""), F.lit("\n")).alias("text")))


def code_only(patch: Column) -> Column:
    """The patch's segments on code paths; empty if there is none."""
    kept = F.filter(segments(patch), lambda s: s["path"].rlike(CODE))
    return F.regexp_replace(F.array_join(F.transform(kept, lambda s: s["text"]), ""), r"(?U)\s+\z", "")


def preimage(patch: Column) -> Column:
    """For each code file its hunks without added lines: headers, context, and deleted lines that aren't file headers."""

    def block(s: Column) -> Column:
        lines = F.split(s["text"], LINE_END)
        headers = F.transform(lines, lambda x: x.startswith("@@"))
        start = F.array_position(headers, F.lit(True)).cast("int")
        hunks = F.filter(F.slice(lines, F.greatest(start, F.lit(1)), F.size(lines)), lambda x: x.rlike("^(?:@@| |-(?!--))"))
        return F.when((start > 0) & (F.size(hunks) > 0), F.concat(F.lit("### "), s["path"], F.lit("\n"), F.array_join(hunks, "\n")))

    blocks = F.array_compact(F.transform(F.filter(segments(patch), lambda s: s["path"].rlike(CODE)), block))
    return F.array_join(blocks, "\n\n")


def fingerprint(patch: Column, mechanism: Column, files: Column, op_family: Column) -> Column:
    """SHA-256 of a patch without what varies between copies (index lines, hunk places, chip names, commits); without a patch, of
    family, mechanism and files."""

    # What a fingerprint doesn't tell apart.
    def line(x: Column) -> Column:
        x = F.regexp_replace(x, r"@@ -[^ ]+ \+[^ ]+ @@", "@@")
        x = F.regexp_replace(x, f"(?i){CHIP}", "sm_x")
        return F.regexp_replace(F.regexp_replace(x, r"\b[0-9a-f]{40}\b", "<commit>"), r"(?U)\s+\z", "")

    lines = F.filter(F.split(F.regexp_replace(patch, f"(?:{LINE_END})\\z", ""), LINE_END), lambda x: ~x.startswith("index "))
    of_patch = F.array_join(F.transform(lines, line), "\n")
    plain = F.concat_ws("|", op_family, F.lower(mechanism), F.lower(files))
    of_text = stripped(F.regexp_replace(F.regexp_replace(plain, CHIP, "sm_x"), r"(?U)\s+", " "))
    return F.sha2(F.when(patch != "", of_patch).otherwise(of_text), 256)


def text_fingerprint(text: Column) -> Column:
    """SHA-256 of a text with one kind of line end, no unstable paths, and single spaces."""
    t = F.regexp_replace(text, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"/(?:tmp|home|root|var)/[^\s]*", "<path>")
    return F.sha2(stripped(F.regexp_replace(t, r"[ \t]+", " ")), 256)


def reverted(subject: Column, body: Column) -> Column:
    """The commit that a message says it reverts, else null."""
    found = F.regexp_extract(body, r"This reverts commit ([0-9a-f]{40})", 1)
    return F.when(subject.startswith("Revert ") & (found != ""), found)
