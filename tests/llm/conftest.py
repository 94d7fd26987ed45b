import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A small table of documents out of (doc_id, text, lang, source) rows."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(*row, *[None] * (4 - len(row)))[:4] for row in rows]
        return spark.createDataFrame(
            [(*row, None if row[1] is None else len(row[1])) for row in full], schema
        )

    return make
