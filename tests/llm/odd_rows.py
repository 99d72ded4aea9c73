"""Rows that operators must stand."""

SHAPE = (
    "doc_id long, text string, lang string, source string, n_chars long, n_lines int, n_dropped int,"
    " score double, size long, copies long, component_id long, line string, fp long, ids array<int>, key long"
)


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source) with extra columns whose names operators use."""
    full = [(i, t, la, s, None, 7, 7, 0.5, 7, 7, 7, "x", 7, [7], 7) for i, t, la, s in rows]
    return spark.createDataFrame(full, SHAPE)


LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, " \t\n \r", "en", "a"), (4, "12 34 !!", "de", "b"),
    (5, "one two", None, "a"), (6, "one two", "en", None), (7, "ONE Two", "en", "b"),
    (8, LONG, "en", "a"), (9, LONG + " tail", "en", "a"), (None, "a row without an id stands here too", "en", "a"),
    (10, "repeated row of some words here", "fr", "a"), (10, "repeated row of some words here", "fr", "a"),
    (11, "nul\x00 and ▁ marks \U0001f600 and é̀", "fr", "c"), (-5, "negative ids come first of all here", "fr", "c"),
]
