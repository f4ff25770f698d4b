"""Results as files (K3, K10, K11). Every sink writes from the executors."""

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str) -> None:
    """K3: Parquet files, replacing what the path holds."""
    df.write.mode("overwrite").parquet(path)


def write_summary_csv(report: DataFrame, path: str) -> None:
    """A report as CSV with a header."""
    report.write.mode("overwrite").option("header", True).csv(path)


def write_json(record: DataFrame, path: str) -> None:
    """One JSON object per row; NULL fields are kept."""
    record.write.mode("overwrite").option("ignoreNullFields", False).json(path)
