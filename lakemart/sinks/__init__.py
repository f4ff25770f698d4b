from lakemart.sinks.files import write_json, write_parquet, write_summary_csv
from lakemart.sinks.tables import (
    append_rows,
    create_namespace,
    create_or_replace,
    create_table,
    create_view,
    drop_table,
    load_raw,
    materialize,
)

__all__ = [
    "append_rows",
    "create_namespace",
    "create_or_replace",
    "create_table",
    "create_view",
    "drop_table",
    "load_raw",
    "materialize",
    "write_json",
    "write_parquet",
    "write_summary_csv",
]
