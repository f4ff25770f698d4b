"""Catalog tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakemart.schemas import TABLES
from lakemart.sources.mapping import Sources


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: a catalog table by qualified name."""
    return spark.table(name)


def catalog_sources(
    spark: SparkSession, namespace: str, tables: Sequence[str] = TABLES
) -> Sources:
    return Sources(tables, lambda table: scan_table(spark, f"{namespace}.{table}"))


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """The tables of a namespace, without the session's temporary views."""
    listed = spark.sql("SHOW TABLES IN IDENTIFIER(:namespace)", args={"namespace": namespace})
    return listed.where("NOT isTemporary")
