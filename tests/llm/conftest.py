import pytest


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from strata.llm.common import importable

    importable(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, and columns that operators use themselves."""
    rows = [
        (1, "the cat sat on the mat again and again and again", "en", "s", 48, 1, "x", 0, 1.0),
        (2, None, "en", "s", None, 2, "x", 0, 1.0),
        (3, "", None, None, 0, 3, "x", 0, 1.0),
        (4, " \t\n", "de", "s", 3, 4, "x", 0, 1.0),
        (5, "The Cat sat on the mat again and again and again", "en", "s", 48, 5, "x", 0, 1.0),
        (5, "The Cat sat on the mat again and again and again", "en", "s", 48, 5, "x", 0, 1.0),
        (None, "a text without id", "en", "s", 17, 6, "x", 0, 1.0),
        (7, "long " * 30_000, "en", "s", 150_000, 7, "x", 0, 1.0),
        (8, "mail a.b@example.com card 4111 1111 1111 1111", "en", "s", 40, 8, "x", 0, 1.0),
        (9, "日本語 😀 <|endoftext|> <s> ▁x  é\x00z", "xx", "s", 20, 9, "x", 0, 1.0),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row long, word string, matches int, score double")
