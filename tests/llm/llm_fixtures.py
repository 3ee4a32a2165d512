import pytest

#: Rows that every operator has to take: nulls, empty and wordless texts, a long
#: text, equal texts under several ids, a repeated row, and columns whose names
#: operators use themselves.
LONG = "alpha beta gamma delta " * 20_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "...!!! 123", "en", None),
        (5, LONG, "en", "a"), (6, "One Two three four five six", "en", "b"), (7, "one two THREE four five six", None, "b"),
        (7, "one two THREE four five six", None, "b"), (8, "é È ñ ß", "fr", "c"), (None, "one two three four five six", "en", "c"),
        (9, None, "en", "a"), (10, "one", "de", "a"), (11, "All Rights Reserved. Licensed under CC BY-NC 4.0.", "en", "a"),
        (12, "x" * 3000, "en", "a"), (13, "日本語 の テキスト 😀", "ja", "a"),
    ]
    return spark.createDataFrame(
        [(*r, 1, "q", 0.5, "w") for r in rows],
        "doc_id long, text string, lang string, source string, n_words int, digest string, score double, __k3 string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
