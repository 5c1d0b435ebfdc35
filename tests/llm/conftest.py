import pytest

# A row of each kind that an operator must take: null, empty, blank, long, repeated, with other scripts.
LONG = "word " * 30_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    rows = [
        (1, None, "s", None, "x", "y"), (2, "", "s", "en", None, "y"), (3, " \n\t ", None, "en", "x", "y"),
        (4, LONG, "s", "en", "x", "y"), (5, "a b c", "t", "de", "x", "y"), (5, "a b c", "t", "de", "x", "y"),
        (None, "Über ½ 語 \x1c new", "t", "de", "x", "y"), (7, "A B C", None, None, "x", "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, score string, kept string")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture
def docs(spark):
    def make(texts, **more):
        rows = [(i, t, "s") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, source string")

    return make
