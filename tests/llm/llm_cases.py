"""Rows that every operator must handle."""

# Null and empty texts, white space only, ties, repeated rows, a null id, a very long text.
LONG = "lorem ipsum dolor sit amet " * 40_000
ODD = [
    (None, "no id at all"),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "same text here"),
    (4, "same text here"),
    (5, "same  text here"),
    (6, LONG),
    (7, LONG),
    (8, "one\ntwo\nthree\nfour"),
    (9, "zero\none\ntwo\nthree"),
]
