import pytest

#: rows that every text operator must survive: nulls, blanks, ties, repeated rows and a clashing extra column
ODD_DOCS = [(1, None, "x"), (2, "", None), (3, " \n\t ", "x"), (4, "Aa b c d e f g h i j k", "y"),
            (4, "Aa b c d e f g h i j k", "y"), (None, "no id here", "z"), (5, "é 世界 \u0000 ﬁ", "z"), (6, "word " * 30_000, "long"),
            (7, "ab\n" * 500, "lines")]
ODD_SCHEMA = "doc_id long, text string, n_words string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_DOCS, ODD_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def model_file():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("piece_bpe_32k.model")
