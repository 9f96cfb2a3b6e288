"""Awkward texts, and document tables with clashing columns."""

WEIRD = [None, "", " ", "\n\n", "a", "a b c", "x" * 5000, "é ñ ü 日本 😀", "\x00\x1f\x85 b", "tab\tand\rreturn\x0b\x0c", "dup line\ndup line\n\ndup line"]


def documents(spark, rows):
    """(doc_id, text) rows with further columns whose names clash with the operators' own."""
    full = [(d, t, "en", "src1", 7, "own", 5, 1.0) for d, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, digest string, n_words int, hash double")
