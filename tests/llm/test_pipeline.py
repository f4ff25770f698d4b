"""The pipeline: each stage judged on its own input, and all of them in a row."""

from collections import Counter

import pytest
from llm_texts import prose
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import stages
from lakemart.llm.common import Steps, table
from lakemart.llm.divergence import quality_by_divergence
from lakemart.llm.ngram_jaccard import ngram_jaccard_join
from lakemart.llm.secret_scan import redacted
from lakemart.llm.toxicity import toxicity


def test_stages_are_in_order():
    names = ["toxicity", "quality rules", "n-gram Jaccard join", "secret scans", "best-fit packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names and corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def steps(spark, tiny):
    """What each stage was given and what it returned."""
    docs, out, kept = table(spark, tiny, "documents"), [], Steps(spark)
    for name, stage in corpus_pipeline.STAGES:
        result = kept.keep(stage(spark, docs, tiny))
        out.append((name, docs, result))
        docs = result
    return {name: (before, after) for name, before, after in out}


def rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_documents_keep_their_columns(spark, tiny, steps):
    columns = table(spark, tiny, "documents").dtypes
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name][1].dtypes == columns


def test_toxic_documents_go(spark, tiny, steps):
    before, after = steps["toxicity"]
    gone = [row.doc_id for row in toxicity(before, table(spark, tiny, "labels")).where("predicted = 1").collect()]
    assert gone and rows(after, *before.columns) == rows(before.where(~F.col("doc_id").isin(gone)), *before.columns)


def test_low_quality_goes(steps):
    before, after = steps["quality rules"]
    kept = [row.doc_id for row in quality_by_divergence(before).where("kept").collect()]
    assert rows(after, *before.columns) == rows(before.where(F.col("doc_id").isin(kept)), *before.columns)


def test_one_document_of_each_group_stays(steps):
    before, after = steps["n-gram Jaccard join"]
    first = sorted({row.class_id for row in ngram_jaccard_join(before).collect()})
    assert sorted(row.doc_id for row in after.collect()) == first
    assert not Counter(rows(after, *before.columns)) - Counter(rows(before, *before.columns))


def test_secrets_are_redacted(steps):
    before, after = steps["secret scans"]
    texts = {row.doc_id: row.text for row in before.collect()}
    for row in after.collect():
        assert row.text == redacted(texts[row.doc_id]) and row.n_chars == len(row.text)
    assert after.count() == before.count()


def test_the_run_is_the_stages(spark, tiny, steps):
    before, packed = steps["best-fit packing"]
    run = corpus_pipeline.run(spark, tiny)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(run, *columns) == rows(packed, *columns)
    assert {row.doc_id for row in packed.collect()} == {row.doc_id for row in before.collect()}


def test_stages_on_odd_documents(spark, odd_docs, small):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "score", "node")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns
        assert not Counter(rows(out, *docs.columns)) - Counter(rows(docs, *docs.columns))
    # repeated rows and near copies of one id leave one row; rows without an id stay
    left = stages.near_duplicates(spark, docs, small)
    assert sorted(row.doc_id for row in left.where("doc_id is not null").collect()) == sorted(
        [1, 2, 3, 4, 5, 7, 8, 9, -10, 11]
    )
    assert left.where("doc_id is null").count() == 2


def test_columns_that_helpers_might_use_are_left_alone(spark, make_docs, small):
    """Names of helper columns, old and new, in either case, as the user's own columns."""
    secret = "my password = hunter2hunter2 and the rest of a calm text about the sea "
    rows = [(i, secret + " ".join(f"w{i}x{j}" for j in range(60))) for i in (0, 1, 2, 3, 9, 9)]
    names = ["changed", "_changed", "KEY", "key_", "First", "_first", "_row_key", "h1", "H2", "_key", "component"]
    docs = make_docs(*rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.selectExpr("*", *[f"concat('{name}', doc_id) AS `{name}`" for name in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.count() > 0
        for row in out.collect():
            assert [row[name] for name in names] == [f"{name}{row.doc_id}" for name in names]
    left = stages.without_secrets(spark, docs, small).collect()
    assert all("hunter2" not in row.text and row.n_chars == len(row.text) for row in left)
    assert stages.near_duplicates(spark, docs, small).where("doc_id = 9").count() == 1


def test_rows_of_one_id_and_rows_without_id_are_documents_of_their_own(spark, make_docs, small):
    a, b, c, d = (prose(50, seed) for seed in (1, 2, 3, 4))
    docs = make_docs(
        (1, a), (1, b), (1, b), (3, b), (5, b), (5, c), (None, c), (None, d), (None, d), (None, f"{d} "),
        (6, None), (6, ""), (None, " "), (None, " "),
    )
    left = [(row.doc_id, (row.text or "").strip()) for row in stages.near_duplicates(spark, docs, small).collect()]
    expected = [(1, a), (1, b), (5, c), (None, d), (6, ""), (6, ""), (None, ""), (None, "")]
    assert sorted(map(repr, left)) == sorted(map(repr, expected))


def test_stages_on_no_documents(spark, no_docs, small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, small).collect() == []
