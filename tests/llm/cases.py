"""Rows that every operator must take: nulls, blanks, ties, repeats, long texts, clashing columns."""

EDGE_SCHEMA = (
    "doc_id long, text string, cls string, fp string, key string, n string, size string,"
    " uid string, source string, lang string, n_chars long"
)


def edge_rows() -> list[tuple]:
    passage = " ".join(f"w{i}" for i in range(70))
    texts = [
        (None, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a b c d"), (5, "ab cd"),
        (6, "a b"), (7, "a b"), (7, "a b"), (7, "a  b"), (8, passage), (9, passage),
        (9, "x " + passage + " y"), (10, passage.upper()), (None, passage), (11, "one"),
        (12, "éè \U0001f600 中文 o"), (13, "word " * 3000), (14, "word " * 3000 + "end"),
        (15, "z" * 20000), (-3, "a b c d"), (16, passage + " " + passage),
    ]
    return [(i, t, "x", "y", None, "z", None, None, "s", "en", None) for i, t in texts]
