"""The corpus pipeline: stages that each take and return documents.

Every stage is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm.common import Steps, table
from lakemart.llm.stages import (
    near_duplicates,
    packed,
    without_low_quality,
    without_secrets,
    without_toxic,
)

STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", without_low_quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: MinHash, learned scores and tokens can't be written in SQL; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    steps, docs = Steps(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = steps.keep(stage(spark, docs, sf_dir))
        steps.drop_all_but(docs)
    packed_docs = STAGES[-1][1](spark, docs, sf_dir)
    # the last stage has written its pieces, which is all that its result reads
    steps.drop_all_but()
    return packed_docs
