"""Reports over run metrics.

Metrics have one row per run: ``query``, ``variant``, ``run``, ``sec`` and
``row_count``. The table may be of any size; every statistic is a partial
aggregate, so a query with most of the runs still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import guarded_ratio

VARIANTS = ("csv", "iceberg")


def _statistics(of: Column | None = None) -> dict[str, Column]:
    """A10: statistics of the runs that meet the condition, or of all runs."""

    def pick(name: str) -> Column:
        return F.col(name) if of is None else F.when(of, F.col(name))

    return {
        "avg_sec": F.avg(pick("sec")),
        "min_sec": F.min(pick("sec")),
        "max_sec": F.max(pick("sec")),
        "stdev_sec": F.stddev_pop(pick("sec")),
        "row_count": F.min_by(F.col("row_count"), pick("run")),
    }


def run_summary(metrics: DataFrame) -> DataFrame:
    """M1: runs, time statistics and the first run's row count."""
    statistics = [column.alias(name) for name, column in _statistics().items()]
    return metrics.groupBy("query", "variant").agg(
        F.count(F.lit(1)).alias("runs"), *statistics
    )


def run_times(metrics: DataFrame) -> DataFrame:
    """The run times of each query and variant in order of the runs.

    One row per run, not one array per group: the sort splits by run too, so
    no task and no row ever holds all runs of a group. The last sort key lets
    it split even a great number of equal rows.
    """
    times = metrics.select("query", "variant", "run", "sec")
    return times.orderBy(*times.columns, F.monotonically_increasing_id())


def paired_report(metrics: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Both variants of a query side by side, in one aggregation.

    ``names`` lists the queries to report in a column ``query``; one without
    any run gets a row of NULLs. By default the queries of the metrics are
    listed. Runs of a variant other than ``csv`` and ``iceberg`` are not shown.
    """
    sides = {side: F.col("variant") == side for side in VARIANTS}
    gathered = [
        column.alias(f"{side}_{name}")
        for side, mine in sides.items()
        for name, column in _statistics(mine).items()
    ]
    report = metrics.groupBy("query").agg(
        F.count_if(sides["csv"]).alias("csv_runs"), *gathered
    )
    if names is not None:
        report = names.select("query").join(report, "query", "left")
    csv_rows, table_rows = F.col("csv_row_count"), F.col("iceberg_row_count")
    return report.select(
        "query",
        "csv_avg_sec",
        "iceberg_avg_sec",
        guarded_ratio(F.col("csv_avg_sec"), F.col("iceberg_avg_sec")).alias("speedup"),
        *[f"{side}_{name}_sec" for name in ("min", "max", "stdev") for side in VARIANTS],
        F.when(F.col("csv_runs") > 0, csv_rows).otherwise(table_rows).alias("row_count"),
    )


def two_series(summary: DataFrame) -> DataFrame:
    """M4: the two average series of a paired report, by query."""
    return summary.select("query", "csv_avg_sec", "iceberg_avg_sec")


def single_query_report(metrics: DataFrame, query: str) -> DataFrame:
    """M5: average time and row count of one query, a row per source.

    Runs of a variant other than ``csv`` and ``iceberg`` are not shown.
    """
    # The names of the two sources in this report.
    labels = {"csv": "CSV", "iceberg": "Iceberg"}
    summary = run_summary(metrics.where(F.col("query") == query))
    source = F.coalesce(
        *[F.when(F.col("variant") == side, label) for side, label in labels.items()]
    )
    return summary.where(F.col("variant").isin(*labels)).select(
        source.alias("source"), "avg_sec", F.col("row_count").alias("rows")
    )


def run_record(
    metrics: DataFrame,
    counts: DataFrame | None = None,
    storage: DataFrame | None = None,
    meta: Mapping[str, object] | None = None,
) -> DataFrame:
    """Everything known about a benchmark as rows of one shape.

    ``(section, name, variant, metric, run, value)``: settings, statistics and
    single times of the queries, row counts and storage.
    """
    statistics = ["runs", "avg_sec", "min_sec", "max_sec", "stdev_sec", "row_count"]
    record = _long(run_summary(metrics), "queries", "query", statistics, "variant")
    times = metrics.select(
        F.lit("queries").alias("section"),
        F.col("query").alias("name"),
        "variant",
        F.lit("times_sec").alias("metric"),
        F.col("run").cast("bigint").alias("run"),
        F.col("sec").cast("string").alias("value"),
    )
    record = record.unionByName(times)
    if counts is not None:
        record = record.unionByName(
            _long(counts, "row_counts", "table_name", ["csv", "iceberg", "diff"])
        )
    if storage is not None:
        sizes = ["csv_bytes", "iceberg_bytes", "compression_ratio"]
        whole = storage.withColumn("root", F.lit("all"))
        record = record.unionByName(_long(whole, "storage", "root", sizes))
    if meta:
        settings = metrics.sparkSession.createDataFrame(
            [("meta", None, None, key, None, str(value)) for key, value in meta.items()],
            "section string, name string, variant string, metric string, run bigint, value string",
        )
        record = record.unionByName(settings)
    return record.select("section", "name", "variant", "metric", "run", "value")


def _long(
    df: DataFrame, section: str, name: str, measures: list[str], variant: str | None = None
) -> DataFrame:
    side = F.col(variant) if variant else F.lit(None).cast("string")
    texts = df.select(
        F.lit(section).alias("section"),
        F.col(name).alias("name"),
        side.alias("variant"),
        *[F.col(measure).cast("string").alias(measure) for measure in measures],
    )
    long = texts.unpivot(["section", "name", "variant"], measures, "metric", "value")
    return long.withColumn("run", F.lit(None).cast("bigint"))
