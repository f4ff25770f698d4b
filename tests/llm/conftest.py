import pytest
from llm_texts import prose

from lakemart.llm.common import table

# columns whose names the operators use inside
CLASHING = "score double, node long, bucket long, _key string, row long, h1 long, part long, word string, n long, class_id long, held_out boolean, size long, side int, component long, rank int, length long, spans string, kept boolean"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns that clash."""

    def make(*rows):
        extra = CLASHING.count(",") + 1
        full = [
            (doc_id, text, *(lang or ["en"]), "src0", len(text or ""), *[None] * extra)
            for doc_id, text, *lang in rows
        ]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, a very long one, repeated rows, odd characters."""
    text = prose(60, 1)
    return make_docs(
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, text), (5, text), (6, text),
        (None, prose(40, 2)), (None, None), (7, prose(30_000, 3)), (8, "naïve “café” 漢字 🎉\x00 ß İ"),
        (9, "x" * 50_000), (-10, "a  b\r\n\n  c"), (11, prose(25, 4), None),
    )


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs()


@pytest.fixture(scope="session")
def tiny_docs(spark):
    """The smallest given documents, as rows and as a table."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    return docs, {row.doc_id: row.text for row in docs.collect()}
