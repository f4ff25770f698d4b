"""The given test tables in the declared types, and as raw files.

The given Parquet has DOUBLE amounts, timestamps for days and fewer columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.schemas import SCHEMAS, TABLES, TRAILING
from lakemart.sources import Sources, scan_parquet


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns, cast; one that is not given is NULL.

    The ship priority of an order is 0 in all data of this kind.
    """
    absent = {"o_shippriority": F.lit(0)}
    return df.select(
        *[
            (F.col(field.name) if field.name in df.columns else absent.get(field.name, F.lit(None)))
            .cast(field.dataType)
            .alias(field.name)
            for field in SCHEMAS[table].fields
        ]
    )


def given_tables(spark: SparkSession, folder: str) -> Sources:
    """All eight tables; part suppliers are derived from the line items."""

    def scan(table: str) -> DataFrame:
        if table == "partsupp":
            lines = scan_parquet(spark, f"{folder}/lineitem.parquet")
            pairs = lines.select(
                F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
            ).distinct()
            return conform(pairs, table)
        return conform(scan_parquet(spark, f"{folder}/{table}.parquet"), table)

    return Sources(TABLES, scan)


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """A metrics table from the events: a run per event, in two variants."""
    events = scan_parquet(spark, f"{folder}/events.parquet")
    return events.select(
        F.col("event_type").alias("query"),
        F.when(F.col("user_id") % 2 == 0, "csv").otherwise("iceberg").alias("variant"),
        F.col("event_id").alias("run"),
        F.col("value").alias("sec"),
        F.col("user_id").alias("row_count"),
    )


def write_raw(tables: Sources, base: str, names: Sequence[str] = TABLES) -> str:
    """Write tables as raw files, each line ending in a delimiter."""
    for name in names:
        lines = tables[name].withColumn(TRAILING.name, F.lit(None).cast(TRAILING.dataType))
        lines.write.options(
            sep="|",
            header=False,
            # blanks at the ends of a text are part of it
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(f"{base}/{name}.tbl")
    return base
