from lakemart.operators.counts import reconcile_counts, row_counts, table_counts
from lakemart.operators.metrics import (
    paired_report,
    run_record,
    run_summary,
    run_times,
    single_query_report,
    two_series,
)
from lakemart.operators.quality import contract_failures, not_null_failures
from lakemart.operators.storage import root_bytes, storage_report

__all__ = [
    "contract_failures",
    "not_null_failures",
    "paired_report",
    "reconcile_counts",
    "root_bytes",
    "row_counts",
    "run_record",
    "run_summary",
    "run_times",
    "single_query_report",
    "storage_report",
    "table_counts",
    "two_series",
]
