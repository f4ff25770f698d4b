from lakemart.sources.catalog import catalog_sources, list_tables, scan_table
from lakemart.sources.files import file_lengths, read_summary_csv, scan_parquet
from lakemart.sources.mapping import Sources
from lakemart.sources.raw import register_raw_views, scan_raw, raw_sources

__all__ = [
    "Sources",
    "catalog_sources",
    "file_lengths",
    "list_tables",
    "raw_sources",
    "read_summary_csv",
    "register_raw_views",
    "scan_parquet",
    "scan_raw",
    "scan_table",
]
