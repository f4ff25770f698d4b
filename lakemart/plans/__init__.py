from lakemart.plans.mart import sales_summary
from lakemart.plans.queries import (
    NAMED_QUERIES,
    pricing_summary,
    promotional_discount,
    top_unshipped_orders,
    preview,
)
from lakemart.plans.sql_text import load_queries, packaged_queries, run_sql
from lakemart.plans.variants import by_variant, choose_variants

__all__ = [
    "NAMED_QUERIES",
    "by_variant",
    "choose_variants",
    "load_queries",
    "packaged_queries",
    "preview",
    "pricing_summary",
    "promotional_discount",
    "run_sql",
    "sales_summary",
    "top_unshipped_orders",
]
