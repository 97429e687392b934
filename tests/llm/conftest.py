import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, gone string, found string, score string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    texts = [
        None, "", " \n ", "one", "é ü\n\nx", "The first line of a longer text here.\nThe second line of a longer text here.",
        "The first line of a longer text here.\nThe sekond line of a longer text here.", "w " * 20_000,
        "call +1 (743) 555-3824 or mail jo.doe7@example.com, card 4785380592391139 from 152.143.123.131 on 2024-02-29",
    ]
    rows = [(i, t, "en", "ab"[i % 2], len(t or ""), "g", "f", "s") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id here, but some words", "en", None, 1, "g", "f", "s"), (50, "one", None, "c", 1, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
