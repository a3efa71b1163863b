import pytest

CLASHING = ("id", "rep", "size", "n", "h", "minima", "source_size", "target", "label", "x", "held_out", "score", "kept", "component_id", "start", "sequence_id", "piece", "fp", "next", "e", "c", "kind")
LONG = "the quick brown fox jumps over the lazy dog near river bank " * 4000
SAME = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows, and clashing further columns."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t\r ", None, "a", 5), (4, LONG, "en", None, len(LONG)), (5, SAME, "en", "b", None), (5, SAME, "en", "b", None),
        (6, SAME, "de", "b", 1), (7, "one", "de", "c", 3), (8, "… — ¡!", "es", "c", 6), (None, SAME + " tail", "en", None, 2), (9, "Größe 你好 мир " * 30, None, None, None), (-4, "\x00odd\ncontrol\x0b chars", "fr", "c", 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'{i}' as {c}" for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
