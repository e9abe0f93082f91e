import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """A shared folder for the landed tables of the tests."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text, lang, source) tuples."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            row = (*row, *("en", "site")[len(row) - 2 :])
            full.append((*row, None if row[1] is None else len(row[1])))
        return spark.createDataFrame(full, DOCS)

    return make
