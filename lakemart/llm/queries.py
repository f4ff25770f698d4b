"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm.best_fit import best_fit_packing
from lakemart.llm.common import table
from lakemart.llm.count_tokens import token_counts
from lakemart.llm.divergence import quality_by_divergence
from lakemart.llm.id_files import id_files_round_trip
from lakemart.llm.merkle import merkle_audit, without_line_feeds
from lakemart.llm.multi_index import nearest_by_multi_index
from lakemart.llm.ngram_jaccard import ngram_jaccard_join
from lakemart.llm.oracle import ORACLE
from lakemart.llm.periodic_runs import repeated_tail, run_digests
from lakemart.llm.prefix_bpe import round_trip_digests
from lakemart.llm.secret_scan import secret_scan
from lakemart.llm.shared_prefix import encode_summary
from lakemart.llm.suffix_tree import suffix_tree_scores
from lakemart.llm.tokens import public_vocabulary
from lakemart.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, folder, "documents"))


def _suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree_scores(table(spark, folder, "documents"))


def _secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents"))


def _divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality_by_divergence(table(spark, folder, "documents"))


def _multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_by_multi_index(table(spark, folder, "embeddings"))


def _shared_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return encode_summary(
        table(spark, folder, "documents"), public_vocabulary("piece_bpe_32k.model")
    )


def _best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing(
        table(spark, folder, "documents"), public_vocabulary("word_bpe_49k.json")
    )


def _id_files(spark: SparkSession, folder: str) -> DataFrame:
    return id_files_round_trip(
        table(spark, folder, "documents"), public_vocabulary("byte_bpe_50k.json")
    )


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(
        table(spark, folder, "documents"), public_vocabulary("piece_bpe_32k.model")
    )


def _prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(
        table(spark, folder, "documents"), public_vocabulary("byte_bpe_50k.json")
    )


def _merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle_audit(docs, without_line_feeds(docs))


def _periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(table(spark, folder, "documents"), order=repeated_tail)


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": _ngram_jaccard,
        "op2_suffix_tree_scores": _suffix_tree,
        "op3_secret_scan": _secrets,
        "op4_quality_by_divergence": _divergence,
        "op5_nearest_by_multi_index": _multi_index,
        "op6_shared_prefix_pieces": _shared_prefix,
        "op7_best_fit_packing": _best_fit,
        "op8_id_files": _id_files,
        "op9_toxicity": _toxicity,
        "op10_token_counts": _token_counts,
        "op11_prefix_bpe": _prefix_bpe,
        "op12_merkle_manifest": _merkle,
        "op13_periodic_runs": _periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
