"""Plain files: Parquet, a report in CSV, and file sizes."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The report columns that are text or whole numbers.
_TEXT_COLUMNS = {"query"}
_WHOLE_COLUMNS = {"row_count"}

#: What Spark calls the error when a table or a path is not there.
MISSING = {"TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND"}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at the path."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        return False
    return True


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files at a path."""
    return spark.read.parquet(path)


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """A report in CSV with a header; text that is no number becomes NULL."""
    report = spark.read.option("header", True).csv(path)
    columns = []
    for name in report.columns:
        if name in _TEXT_COLUMNS:
            columns.append(F.col(name))
        else:
            kind = "bigint" if name in _WHOLE_COLUMNS else "double"
            columns.append(F.col(name).try_cast(kind).alias(name))
    return report.select(*columns)


def file_lengths(spark: SparkSession, roots: str | Sequence[str]) -> DataFrame:
    """One row per file under the roots, with its length in bytes.

    Hidden files, whose names start with ``_`` or ``.``, are not listed.
    Only the listing is used, file contents are pruned from the scan. The scan
    plans a task per 128 MB of file, which would be idle tasks by the hundred
    thousand on a large root, so neighbours are merged without a shuffle.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    tasks = 4 * spark.sparkContext.defaultParallelism
    return files.select(F.col("length").alias("bytes")).coalesce(tasks)
