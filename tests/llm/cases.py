"""Rows shared by the tests of the pipeline operators."""

SF = "/root/testdata/sf0.001"

#: Rows every operator must take: null and empty text, blanks, ties, repeated rows, a long text.
ODD = [
    (1, None), (2, ""), (3, " "), (4, "one"), (5, "one"), (5, "one"), (None, "no id"), (7, "ñ é 😀 \x00 end\n\nend"),
    (8, "long " * 30_000), (9, "x" * 40_000), (10, "long " * 30_000 + "tail"), (11, None),
]
