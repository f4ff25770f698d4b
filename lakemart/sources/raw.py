"""Pipe-delimited raw files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemart.schemas import SCHEMAS, TABLES, TRAILING
from lakemart.sources.mapping import Sources


def scan_raw(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Scan ``<base>/<table>.tbl`` with its fixed schema.

    The parse mode stays permissive: an unreadable field becomes NULL and the
    row is kept. Nothing is inferred, so no pass over the data is spent on it.
    """
    schema = StructType([*SCHEMAS[table].fields, TRAILING])
    lines = spark.read.schema(schema).options(sep="|", header=False)
    return lines.csv(f"{base.rstrip('/')}/{table}.tbl").drop(TRAILING.name)


def raw_sources(
    spark: SparkSession, base: str, tables: Sequence[str] = TABLES
) -> Sources:
    return Sources(tables, lambda table: scan_raw(spark, base, table))


def register_raw_views(
    spark: SparkSession, base: str, tables: Sequence[str] = TABLES, prefix: str = "csv_"
) -> list[str]:
    """One temporary view per raw table; returns the view names."""
    for table in tables:
        scan_raw(spark, base, table).createOrReplaceTempView(prefix + table)
    return [prefix + table for table in tables]
