"""Rows that every operator must stand."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i} and{i % 97}" for i in range(30000))

#: Null, empty, blank, very long, repeated rows, ties, no id, no source.
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "one two three"), (5, "one two three"), (6, "one two three"), (None, "four five six seven eight"),
    (None, None), (7, "solo", None), (8, "Ünï çödé 日本語 \x1c   words", None),
]
