import pytest

from crawlspark.llm.common import importable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers_import(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """``make(rows)``: documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = []
        for doc_id, text, *names in rows:
            lang, source = (*names, None, None)[:2]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)

    return make
