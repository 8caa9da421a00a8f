"""Inputs that several tests share."""

SMALL = "/root/testdata/sf0.001"

# Rows that every operator must take: nulls in any column, empty, blank and very
# long texts, ties, repeated rows, and columns named as the operators name theirs.
ODD = [
    (1, "one two three four five six", "a", 1),
    (2, None, None, None),
    (None, "one two three four five six", "a", 2),
    (3, "", "b", 3),
    (4, " \t\n", "b", 3),
    (5, "Ünïcode wörds 中文 😀 and more words here", None, 4),
    (5, "Ünïcode wörds 中文 😀 and more words here", None, 4),
    (6, "one two three four five six", "a", 1),
    (7, "word " * 30_000, "c", 5),
    (8, "x" * 100_000, "c", 5),
    (None, None, None, None),
]
SCHEMA = "doc_id long, text string, source string, size int"
