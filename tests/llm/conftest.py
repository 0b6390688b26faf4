import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and names that operators use."""
    long = "lorem ipsum dolor sit amet " * 3000
    words = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, words, "en", "a", 1, "x", 7), (1, words, "en", "a", 1, "x", 7),
        (2, words, "en", "a", 1, "y", 7), (3, "", None, None, None, None, None),
        (4, None, "de", "b", None, None, None), (None, "alpha beta gamma delta", "en", None, 3, "", 0),
        (None, "alpha beta gamma delta", "en", None, 3, "", 0), (None, None, None, None, None, None, None),
        (5, long, "fr", "b", 2, "z", 1), (6, " \t\n ", "fr", "", 2, "z", 1), (7, "one", "en", "c", 2, "z", 1),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _row string, _id long"
    )


@pytest.fixture()
def labels(spark):
    rows = [(1, 1, 0), (2, None, 1), (None, 0, 1), (5, 0, None), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
