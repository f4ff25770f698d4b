"""The registered queries over whole tables."""

import pytest

import __spark_entry__ as entry_point
from lakemart.llm import queries as llm

COLUMNS = {
    "op1_ngram_jaccard_join": {"doc_id", "class_id", "n_links"},
    "op2_suffix_tree_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op3_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op4_quality_by_divergence": {
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    },
    "op5_nearest_by_multi_index": {"query_id", "rank", "vec_id", "score"},
    "op6_shared_prefix_pieces": {"doc_id", "n_tokens", "score", "ids_crc32", "exact", "decoded_crc32"},
    "op7_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op8_id_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op9_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op10_token_counts": {"doc_id", "n_tokens", "score"},
    "op11_prefix_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op12_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op13_periodic_runs": {
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    },
}


def test_names():
    assert set(llm.queries()) == set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, tiny, name):
    result = entry_point.queries()[name](spark, tiny)
    assert COLUMNS[name] <= set(result.columns)
    documents = spark.read.parquet(f"{tiny}/documents.parquet").count()
    least = {"op5_nearest_by_multi_index": 1, "op7_best_fit_packing": documents + 1}.get(name, documents)
    assert result.count() >= least
