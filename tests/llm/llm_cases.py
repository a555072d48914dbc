#: Nulls, blanks, a short and a very long text, ties and repeated rows, odd characters.
AWKWARD = [
    (None, "only a null id"), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "word"), (4, "word"), (4, "another text of the same id"),
    (5, "the cat sat on the mat and then it sat on the hat"), (6, "the cat sat on the mat and then it sat on the hat"),
    (7, "é́ \U0001f600 ﬃ ΑΣ. \x1c\x85　 <|endoftext|> 12½"), (8, "x" * 300_000), (9, "so it goes " * 20_000), (-3, "a b c d"),
]
