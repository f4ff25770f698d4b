"""What the stages of the corpus pipeline decide on, each with one operator.

A stage takes ``(spark, docs, folder)``. All but the last return the columns of
documents, with all rows and whole texts of what they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.best_fit import best_fit_packing
from lakemart.llm.common import fresh_names, table
from lakemart.llm.divergence import drop_low_quality
from lakemart.llm.ngram_jaccard import first_of_groups, row_key
from lakemart.llm.secret_scan import redact_secrets
from lakemart.llm.tokens import public_vocabulary
from lakemart.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that the toxicity classifier predicts to be toxic."""
    return drop_toxic(docs, table(spark, folder, "labels"))


def without_low_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that fail the base rules or are far from every language reference."""
    return drop_low_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document, of the least id, of each group of near duplicates.

    Rows are told apart by id and text, so rows that repeat an id are documents
    of their own, and so are rows without an id, which come last in their group.
    A text without words is no duplicate and stays.
    """
    key, group = fresh_names(docs.columns, "key", "first")
    first = first_of_groups(docs).withColumnRenamed("key", group)
    worded = F.coalesce(docs["text"].cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.where(worded).withColumn(key, row_key(docs["doc_id"], docs["text"]))
    # one shuffle by key serves the join and the search for repeated rows
    kept = keyed.join(first.hint("merge"), F.col(key) == F.col(group))
    return kept.dropDuplicates([key]).select(*docs.columns).unionByName(docs.where(~worded))


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with a placeholder for each secret; ``n_chars`` follows the text."""
    return redact_secrets(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as pieces in sequences of 4096 tokens."""
    return best_fit_packing(docs, public_vocabulary("word_bpe_49k.json"))
