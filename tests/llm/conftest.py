import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Small documents with the awkward cases: nulls, blanks, repeated rows, ties, a clashing extra column."""
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta", "a"), (2, "Alpha beta gamma delta epsilon zeta eta theta", "a"),
            (3, None, None), (4, "", "b"), (5, " \n\t ", "b"), (6, "one", "b"), (7, "word " * 3000, "c"),
            (8, "über straße naïve café " * 9, "c"), (9, "x y z\nx y z\n\nnew section here", "a"), (9, "x y z\nx y z\n\nnew section here", "a"),
            (10, "some other text with words of its own kind and more to say about it", None)]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 0.5) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score double")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
