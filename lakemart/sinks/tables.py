"""Catalog tables: create, replace, append, drop (K1, K2, K4-K9).

Two kinds of catalog are served. A catalog plugin that replaces tables itself
(Iceberg) is asked to do so. Spark's own session catalog cannot, so there the
new rows go to a new folder first and the name moves to it afterwards: a failed
write leaves the old table whole and a table may be rebuilt from itself. The
old table keeps a spare name until the new one has its own, and gets it back if
that fails. Queries that read the old files finish if the old table has a folder
of its own, as all tables made here have; a managed table's files go with it.
The old folder stays on storage until its owner removes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemart.schemas import TABLES
from lakemart.sources.raw import scan_raw


def create_namespace(spark: SparkSession, namespace: str) -> None:
    """K4: create the namespace unless it is there."""
    spark.sql(
        "CREATE NAMESPACE IF NOT EXISTS IDENTIFIER(:namespace)",
        args={"namespace": namespace},
    )


def create_table(
    spark: SparkSession, name: str, schema: StructType, root: str | None = None
) -> None:
    """K5: create an empty typed table unless it is there."""
    if _replaces_tables(spark, name):
        tail = "USING iceberg"
    else:
        tail = f"USING parquet LOCATION '{_new_folder(spark, name, root)}'"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({schema.toDDL()}) {tail}",
        args={"name": name},
    )


def create_or_replace(df: DataFrame, name: str, root: str | None = None) -> None:
    """K1: make ``name`` a Parquet + Snappy table that holds ``df``.

    ``root`` is the folder for the files, by default the session's warehouse.
    """
    spark = df.sparkSession
    if _replaces_tables(spark, name):
        (
            df.writeTo(name)
            .using("iceberg")
            .tableProperty("write.format.default", "parquet")
            .tableProperty("write.parquet.compression-codec", "snappy")
            .createOrReplace()
        )
        return
    there = spark.catalog.tableExists(name)
    if there and spark.catalog.getTable(name).tableType == "VIEW":
        raise ValueError(f"{name} is a view, not a table")
    unique = uuid.uuid4().hex
    fresh, spare = f"{name}__new_{unique}", f"{name}__old_{unique}"
    try:
        (
            df.write.format("parquet")
            .option("compression", "snappy")
            .option("path", _new_folder(spark, name, root))
            .saveAsTable(fresh)
        )
        if there:
            _rename(spark, name, spare)
        try:
            _rename(spark, fresh, name)
        except BaseException:
            if there:
                _rename(spark, spare, name)
            raise
    except BaseException:
        drop_table(spark, fresh)
        raise
    if there:
        drop_table(spark, spare)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(
        "ALTER TABLE IDENTIFIER(:old) RENAME TO IDENTIFIER(:new)", args={"old": old, "new": new}
    )


def append_rows(df: DataFrame, name: str) -> None:
    """K6: add rows to an existing table, matched by column name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        raise ValueError(f"no table {name}")
    if _replaces_tables(spark, name):
        df.writeTo(name).append()
    else:
        df.write.mode("append").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """K7: remove the table from the catalog if it is there."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def load_raw(
    spark: SparkSession,
    base: str,
    namespace: str,
    tables: Sequence[str] = TABLES,
    root: str | None = None,
) -> list[str]:
    """K2: load raw files into tables of the namespace; returns their names.

    One Spark write per table, no shuffle: each task writes what it parsed.
    """
    create_namespace(spark, namespace)
    names = [f"{namespace}.{table}" for table in tables]
    for table, name in zip(tables, names):
        create_or_replace(scan_raw(spark, base, table), name, root)
    return names


def materialize(
    model: DataFrame, name: str, kind: str = "table", root: str | None = None
) -> DataFrame:
    """K8, K9: build a model as a table or a temporary view and return it."""
    if kind == "table":
        create_or_replace(model, name, root)
    elif kind == "view":
        model.createOrReplaceTempView(name)
    else:
        raise ValueError(f"kind must be 'table' or 'view', not {kind!r}")
    return model.sparkSession.table(name)


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """K9: a lasting view over catalog tables, from query text."""
    spark.sql(f"CREATE OR REPLACE VIEW IDENTIFIER(:name) AS {query}", args={"name": name})
    return spark.table(name)


def _replaces_tables(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    plugin = spark.conf.get(f"spark.sql.catalog.{catalog}", None)
    return plugin is not None and "iceberg" in plugin.lower()


def _new_folder(spark: SparkSession, name: str, root: str | None) -> str:
    base = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name.replace('.', '/')}/{uuid.uuid4().hex}"
