"""Row counts per table, on one side or two.

Every table is counted by its own global aggregate, which sends one row per
task; all counts of a report are one Spark job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.files import MISSING

Tables = Mapping[str, DataFrame]


def row_counts(tables: Tables, names: Iterable[str] | None = None) -> DataFrame:
    """``(table_name, n)`` for the named tables."""
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in (tables if names is None else names)
    ]
    return reduce(DataFrame.unionByName, counts)


def table_counts(spark: SparkSession, namespace: str, names: Sequence[str]) -> DataFrame:
    """V3: counts of catalog tables; a table that is not there counts as NULL."""
    found = {
        name: spark.table(f"{namespace}.{name}")
        for name in names
        if spark.catalog.tableExists(f"{namespace}.{name}")
    }
    return _with_missing(spark, found, names)


def _with_missing(spark: SparkSession, found: Tables, names: Sequence[str]) -> DataFrame:
    missing = [(name, None) for name in names if name not in found]
    parts = [spark.createDataFrame(missing, "table_name string, n bigint")] if missing else []
    if found:
        parts.append(row_counts(found))
    return reduce(DataFrame.unionByName, parts)


def _found_counts(tables: Tables, names: Sequence[str]) -> DataFrame:
    found = {}
    for name in names:
        try:
            found[name] = tables[name]
        except KeyError:
            pass
        except AnalysisException as error:
            if error.getCondition() not in MISSING:
                raise
    return _with_missing(SparkSession.active(), found, names)


def reconcile_counts(raw: Tables, loaded: Tables, names: Iterable[str]) -> DataFrame:
    """``(table_name, csv, iceberg, diff)`` with ``diff = csv - iceberg``.

    A table that a side doesn't have counts as NULL there.
    """
    names = list(names)
    sides = _found_counts(raw, names).withColumn("side", F.lit("csv")).unionByName(
        _found_counts(loaded, names).withColumn("side", F.lit("iceberg"))
    )
    paired = sides.groupBy("table_name").pivot("side", ["csv", "iceberg"]).agg(F.first("n"))
    return paired.withColumn("diff", F.col("csv") - F.col("iceberg"))
