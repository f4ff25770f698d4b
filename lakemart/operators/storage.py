"""Storage use of the raw files and the tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import readable_size, safe_ratio
from lakemart.sources.files import exists, file_lengths


def root_bytes(spark: SparkSession, roots: str | Sequence[str]) -> DataFrame:
    """One row with the total ``bytes`` of the files under the roots.

    NULL if a root is not there, as a sum of the rest would mislead.
    """
    if not all(exists(spark, root) for root in ([roots] if isinstance(roots, str) else roots)):
        return spark.createDataFrame([(None,)], "bytes bigint")
    total = F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    return file_lengths(spark, roots).agg(total)


def storage_report(
    spark: SparkSession, raw: str | Sequence[str], loaded: str | Sequence[str]
) -> DataFrame:
    """M3: bytes of both sides, their readable sizes and the ratio, one row."""
    sides = root_bytes(spark, raw).withColumn("side", F.lit("csv")).unionByName(
        root_bytes(spark, loaded).withColumn("side", F.lit("iceberg"))
    )
    report = sides.agg(
        F.max(F.when(F.col("side") == "csv", F.col("bytes"))).alias("csv_bytes"),
        F.max(F.when(F.col("side") == "iceberg", F.col("bytes"))).alias("iceberg_bytes"),
    )
    return report.select(
        "csv_bytes",
        "iceberg_bytes",
        readable_size(F.col("csv_bytes")).alias("csv_size"),
        readable_size(F.col("iceberg_bytes")).alias("iceberg_size"),
        safe_ratio(F.col("csv_bytes"), F.col("iceberg_bytes")).alias("compression_ratio"),
    )
