"""Times the headline queries and prints one JSON line.

Every query runs against the noop sink, which computes all rows and columns.
After the warm-up runs, the mean of the timed runs counts. The named queries run
on raw text files and on the tables that the load makes of them; writing the raw
files is not timed. For comparison with published numbers, taken with
``count()``, which lets Spark drop the aggregates, the declared queries are timed
in that way as well.

BENCH_SF_DIR names the tables, BENCH_ROOT the folder for the written copies.
BENCH_COPIES (1) loads the facts so many times, with keys of their own.
"""

import json
import os
import sys
import tempfile
import time
from datetime import date
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakemart import fixtures, operators, plans, sinks, sources  # noqa: E402
from lakemart.session import build_spark, drop_cached  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARMUP = int(os.environ.get("BENCH_WARMUP", "2"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
COUNTED = ("q1_groupby", "q3_top10", "q6_discount")
VARIANTS = {"csv": "csv", "table": "iceberg"}


def computed(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def copied(tables: sources.Sources) -> sources.Sources:
    """The tables with facts ``COPIES`` times over, under keys of their own."""
    if COPIES == 1:
        return tables
    shift = 10**8

    def scan(table: str) -> DataFrame:
        if table not in ("orders", "lineitem"):
            return tables[table]
        key = "o_orderkey" if table == "orders" else "l_orderkey"
        copies = F.sequence(F.lit(0), F.lit(COPIES - 1)).cast("array<bigint>")
        many = tables[table].withColumn("copy", F.explode(copies))
        return many.withColumn(key, F.col(key) + F.col("copy") * shift).drop("copy")

    return sources.Sources(list(tables), scan)


def timed(spark, make_frame, run=computed) -> list[float]:
    seconds = []
    for _ in range(WARMUP + RUNS):
        drop_cached(spark)
        start = time.perf_counter()
        run(make_frame())
        seconds.append(time.perf_counter() - start)
    return seconds[WARMUP:]


def main() -> None:
    root = os.environ.get("BENCH_ROOT") or tempfile.gettempdir()
    scratch = tempfile.mkdtemp(prefix="lakemart-bench-", dir=root)
    spark = build_spark(
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
        app_name="lakemart-bench",
    )
    spark.sparkContext.setLogLevel("ERROR")

    given = copied(fixtures.given_tables(spark, FOLDER))
    raw_base = fixtures.write_raw(given, f"{scratch}/raw")
    start = time.perf_counter()
    sinks.load_raw(spark, raw_base, "bench", root=f"{scratch}/lake")
    load_seconds = time.perf_counter() - start
    raw = sources.raw_sources(spark, raw_base)
    loaded = sources.catalog_sources(spark, "bench")

    # The given ship dates begin in 1995; the default year would read nothing.
    year = partial(plans.promotional_discount, start=date(1996, 1, 1), end=date(1997, 1, 1))
    named = {**plans.NAMED_QUERIES, "q6_discount": year}
    frames = {
        f"{name}_{suffix}": (lambda query=query, tables=tables: query(tables))
        for suffix, tables in (("csv", raw), ("table", loaded))
        for name, query in named.items()
    }
    metrics = fixtures.run_metrics(spark, FOLDER)
    frames["mart_not_null"] = lambda: operators.not_null_failures(
        plans.sales_summary(loaded), plans.mart.NOT_NULL_COLUMNS
    )
    frames["row_count_reconcile"] = lambda: operators.reconcile_counts(raw, loaded, raw)
    frames["paired_report"] = lambda: operators.paired_report(metrics)

    runs = {name: timed(spark, frame) for name, frame in frames.items()}
    seconds = {name: round(sum(times) / len(times), 4) for name, times in runs.items()}
    counted = {
        name: timed(spark, frame, DataFrame.count)
        for name, frame in frames.items()
        if name.rsplit("_", 1)[0] in COUNTED
    }
    count_seconds = {name: round(sum(times) / len(times), 4) for name, times in counted.items()}

    # The same numbers through the package's own reports.
    measured = [
        (name.rsplit("_", 1)[0], VARIANTS[name.rsplit("_", 1)[1]], run, sec, 0)
        for name, times in runs.items()
        if name.rsplit("_", 1)[1] in VARIANTS
        for run, sec in enumerate(times)
    ]
    own = spark.createDataFrame(
        measured, "query string, variant string, run int, sec double, row_count bigint"
    )
    report = operators.paired_report(own).collect()
    storage = operators.storage_report(spark, raw_base, f"{scratch}/lake").first()
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "mean seconds per query, summed",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "count_seconds": count_seconds,
                "copies": COPIES,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "warmup": WARMUP,
                "runs": RUNS,
                "cpus": int(CPUS),
                "load_raw_sec": round(load_seconds, 4),
                "speedup_csv_to_table": {
                    row.query: round(row.speedup, 3) for row in report if row.speedup
                },
                "compression_ratio": round(storage.compression_ratio, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
