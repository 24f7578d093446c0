SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

#: id, text, and columns whose names operators use themselves: nulls, empty and wordless texts, a
#: long one, repeated rows, an id twice, a null id.
ODD = [
    (1, None, "a", 1), (2, "", "a", 1), (3, " \n\t ", None, 1), (4, "word", "b", None),
    (5, "The same words in the same row of words, and some more of them.", "x", 1),
    (5, "The same words in the same row of words, and some more of them.", "x", 1),
    (6, "x" * 300_000, "x", 1), (7, "the long road of it " * 20_000, "x", 1),
    (8, "the long road of it " * 20_000, "x", 1), (None, "An id is not given here at all, is it?", "y", 1),
    (9, "a b   c\u0085d \U0001F600 \u0000 e", "x", 1), (10, "-- ... !!", "x", 1),
]
ODD_SCHEMA = "doc_id long, text string, score string, kept int"
