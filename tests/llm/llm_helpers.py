"""Small documents that hold the cases every operator must stand."""

from __future__ import annotations

DOCS = "doc_id long, text string"
# Columns that clash with names the operators use inside.
CLASHING = "doc_id long, text string, key string, row int, ord string, marks int, features string, id int, n_chars long"


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def odd_texts():
    """Null, empty, blank, one word, repeated and long texts, ids null, tied and repeated."""
    long = " ".join(f"w{i % 997}" for i in range(6000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one two"), (6, "ONE two"), (7, long), (8, long + " end"),
            (8, long + " end"), (9, long), (None, "no id here"), (None, None), (4, "same id, other text"),
            (10, "▁ a  b 日本語 😀　x"), (11, "a " * 500), (12, "x" * 20000)]


def with_clashes(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "o", 2, "f", 3, None if t is None else len(t)) for i, t in rows], CLASHING)
