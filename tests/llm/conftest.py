import pytest

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return DIR


@pytest.fixture
def docs_of(spark):
    """Documents frame from (doc_id, text) pairs, with a clashing extra column."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, part string")
    return make


EDGE_TEXTS = [(1, None), (2, ""), (3, "one"), (4, "a b c d"), (5, " \t\n "), (6, "long " * 30000), (7, "long " * 30000),
              (8, "same text of five words here"), (8, "same text of five words here"), (None, "null id text of five words")]


@pytest.fixture
def edge_rows():
    return EDGE_TEXTS
