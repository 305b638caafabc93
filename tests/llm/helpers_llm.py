"""Documents with every awkward case, and a brute-force view of them."""

from __future__ import annotations

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return, as extra columns of their input.
CLASH = ["digest", "keep_id", "kept", "fp", "fingerprint", "component_id", "n_tokens", "start", "found", "edits", "lang_pred", "score", "held_out", "u", "v", "key", "host", "page", "first", "heavy", "row", "spread"]


def frame(spark, rows, clash=False):
    """(doc_id, text[, lang]) rows as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOC)
    for name in CLASH if clash else ():
        df = df.selectExpr("*", f"'x' as {name}")
    return df


AWKWARD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "One two three four five six seven."), (5, "one TWO three four five six seven."),
    (5, "one TWO three four five six seven."), (6, "123 456 !!"), (7, "naïve café — 漢字 \U0001f600 ▁x  y"), (8, "word " * 30_000), (None, "no id at all, is there?"),
]
