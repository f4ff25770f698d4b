"""The queries of this package over the given tables, with their oracle SQL.

Operators keep decimals and dates. The wrappers here turn decimals into DOUBLE
at the very end, so that both engines report the same types; decimal sums make
the values independent of row order.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import DateType, DecimalType  # noqa: E402

from lakemart import fixtures, operators, plans, sinks, sources  # noqa: E402
from lakemart.functions import readable_size  # noqa: E402
from lakemart.plans.mart import NOT_NULL_COLUMNS  # noqa: E402
from lakemart.schemas import (  # noqa: E402
    ACCEPTED_RANGES,
    ACCEPTED_VALUES,
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    SCHEMAS,
    TABLES,
)
from lakemart.session import shared_folder  # noqa: E402

try:  # the operators on training text are a part that may be left out
    import corpus_pipeline
    from lakemart.llm import queries as llm
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "lakemart.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_FOLDER = "/root/testdata/sf0.001"

YEAR_1996 = {"start": dt.date(1996, 1, 1), "end": dt.date(1997, 1, 1)}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE; an average of decimals already has 6 digits."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """DOUBLE columns rounded: their sums depend on the order of the rows."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(name, digits).alias(name) if kinds[name] == "double" else F.col(name)
            for name in df.columns
        ]
    )


# --- data written on the way, once per session and input folder -------------

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, folder: str, what: str, write: Callable[[], str]) -> str:
    """The place of ``what``, written at its first use."""
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _written:
        _written[key] = write()
    return _written[key]


def _folder_once(
    spark: SparkSession, folder: str, what: str, write: Callable[[str], None]
) -> str:
    """A new shared folder that holds ``what``."""

    def fill() -> str:
        path = shared_folder(spark)
        write(path)
        return path

    return _once(spark, folder, what, fill)


def _raw_base(spark: SparkSession, folder: str, *tables: str) -> str:
    """The folder of the raw files, with at least these tables in it."""
    base = _once(spark, folder, "raw", lambda: shared_folder(spark))
    given = fixtures.given_tables(spark, folder)
    for table in tables:
        _once(spark, folder, f"raw {table}", lambda: fixtures.write_raw(given, base, [table]))
    return base


def _raw_tables(spark: SparkSession, folder: str) -> sources.Sources:
    """The given tables as raw files, each written when first asked for."""
    return sources.Sources(
        TABLES,
        lambda table: sources.scan_raw(spark, _raw_base(spark, folder, table), table),
    )


def _namespace_once(
    spark: SparkSession, folder: str, purpose: str, fill: Callable[[str, str], None]
) -> str:
    """A namespace whose tables ``fill(namespace, folder)`` writes at the first use."""

    def write() -> str:
        root = shared_folder(spark)
        namespace = f"lakemart_{purpose}_{root.rsplit('-', 1)[-1].lower()}"
        sinks.create_namespace(spark, namespace)
        fill(namespace, root)
        return namespace

    return _once(spark, folder, f"namespace {purpose}", write)


# --- queries ----------------------------------------------------------------


def _on_given(query: Callable[[sources.Sources], DataFrame]) -> Query:
    return lambda spark, folder: _plain(query(fixtures.given_tables(spark, folder)))


def _on_raw(query: Callable[[sources.Sources], DataFrame]) -> Query:
    return lambda spark, folder: _plain(query(_raw_tables(spark, folder)))


def _packaged(name: str, params: dict | None = None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = fixtures.given_tables(spark, folder)
        return _plain(plans.run_sql(spark, plans.packaged_queries()[name], tables, params))

    return query


def _inline_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The pricing summary as text over any one table, here called ``table``."""
    text = plans.packaged_queries()["q1_groupby"].replace("{lineitem}", "{table}")
    lineitem = fixtures.given_tables(spark, folder)["lineitem"]
    return _plain(plans.run_sql(spark, text, {"table": lineitem}))


def _mart_namespace(spark: SparkSession, folder: str) -> str:
    def fill(namespace: str, root: str) -> None:
        mart = plans.sales_summary(fixtures.given_tables(spark, folder))
        sinks.materialize(mart, f"{namespace}.sales_summary", "table", root)

    return _namespace_once(spark, folder, "mart", fill)


def _summary_table(spark: SparkSession, folder: str) -> DataFrame:
    name = f"{_mart_namespace(spark, folder)}.sales_summary"
    return _plain(sources.scan_table(spark, name))


def _lasting_view(spark: SparkSession, folder: str) -> DataFrame:
    namespace = _mart_namespace(spark, folder)
    text = (
        "SELECT region_name, CAST(sum(total_revenue) AS DECIMAL(38, 4)) AS total_revenue, "
        f"sum(order_count) AS order_count FROM {namespace}.sales_summary GROUP BY region_name"
    )
    return _plain(sinks.create_view(spark, f"{namespace}.by_region", text))


def _summary_view(spark: SparkSession, folder: str) -> DataFrame:
    mart = plans.sales_summary(fixtures.given_tables(spark, folder))
    return _plain(sinks.materialize(mart, "sales_summary_view", "view"))


def _given_columns(spark: SparkSession, folder: str, table: str) -> list[str]:
    """The declared columns that the given tables have, and those that are derived."""
    there = {"ps_partkey", "ps_suppkey", "o_shippriority"}
    if table != "partsupp":
        there |= set(sources.scan_parquet(spark, f"{folder}/{table}.parquet").columns)
    return [name for name in SCHEMAS[table].fieldNames() if name in there]


def _raw_scan(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        raw = _raw_tables(spark, folder)[table]
        return _plain(raw.select(*_given_columns(spark, folder, table)))

    return query


def _raw_view(spark: SparkSession, folder: str) -> DataFrame:
    """One view for each raw table; the totals are those of the orders."""
    views = sources.register_raw_views(spark, _raw_base(spark, folder, *TABLES))
    (view,) = [name for name in views if name.endswith("_orders")]
    return _plain(
        spark.sql(
            "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total "
            "FROM IDENTIFIER(:view) GROUP BY o_orderstatus",
            args={"view": view},
        )
    )


def _raw_views(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and the sum of the first key, from the views of all raw tables."""
    views = sources.register_raw_views(spark, _raw_base(spark, folder, *TABLES))
    of_table = {table: next(v for v in views if v.endswith(f"_{table}")) for table in TABLES}
    texts = [
        f"SELECT '{table}' AS table_name, count(*) AS n, "
        f"sum({SCHEMAS[table].fields[0].name}) AS keys FROM IDENTIFIER(:{table})"
        for table in TABLES
    ]
    return spark.sql(" UNION ALL ".join(texts), args=of_table)


def _by_variant(query: Callable[[sources.Sources], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw, given = _raw_tables(spark, folder), fixtures.given_tables(spark, folder)
        return _plain(plans.by_variant(query, plans.choose_variants("both", raw, given)))

    return run


def _loaded_namespace(spark: SparkSession, folder: str) -> str:
    """The namespace of all eight tables, loaded from raw files."""

    def load(namespace: str, root: str) -> None:
        sinks.load_raw(spark, _raw_base(spark, folder, *TABLES), namespace, root=root)

    return _namespace_once(spark, folder, "load", load)


def _on_loaded(query: Callable[[sources.Sources], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(query(sources.catalog_sources(spark, _loaded_namespace(spark, folder))))

    return run


def _reconcile(spark: SparkSession, folder: str) -> DataFrame:
    namespace = _loaded_namespace(spark, folder)
    listed = sources.list_tables(spark, namespace).select("tableName")
    counts = operators.reconcile_counts(
        _raw_tables(spark, folder), sources.catalog_sources(spark, namespace), TABLES
    )
    shown = counts.join(listed, F.col("table_name") == F.col("tableName"), "left")
    return shown.withColumn("listed", F.col("tableName").isNotNull()).drop("tableName")


def _partly_loaded(spark: SparkSession, folder: str) -> str:
    """A namespace with all tables but ``ABSENT``."""

    def load(namespace: str, root: str) -> None:
        names = [table for table in TABLES if table != ABSENT]
        sinks.load_raw(spark, _raw_base(spark, folder, *TABLES), namespace, names, root)

    return _namespace_once(spark, folder, "partly", load)


def _reconcile_partly(spark: SparkSession, folder: str) -> DataFrame:
    loaded = sources.catalog_sources(spark, _partly_loaded(spark, folder))
    return operators.reconcile_counts(_raw_tables(spark, folder), loaded, TABLES)


def _table_counts(spark: SparkSession, folder: str) -> DataFrame:
    return operators.table_counts(spark, _partly_loaded(spark, folder), TABLES)


def _replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """Loads the orders, then rebuilds the table from itself with a new column."""

    def fill(namespace: str, root: str) -> None:
        name = f"{namespace}.orders"
        sinks.create_or_replace(fixtures.given_tables(spark, folder)["orders"], name, root)
        dated = sources.scan_table(spark, name).withColumn("order_year", F.year("o_orderdate"))
        sinks.create_or_replace(dated, name, root)

    namespace = _namespace_once(spark, folder, "replace", fill)
    replaced = sources.scan_table(spark, f"{namespace}.orders")
    return _plain(replaced.select(*_given_columns(spark, folder, "orders"), "order_year"))


def _append_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Creates an empty table and adds all orders in two steps."""

    def fill(namespace: str, root: str) -> None:
        name = f"{namespace}.orders"
        sinks.create_table(spark, name, SCHEMAS["orders"], root)
        orders = fixtures.given_tables(spark, folder)["orders"]
        for step in ("o_orderstatus <=> 'O'", "NOT o_orderstatus <=> 'O'"):
            sinks.append_rows(orders.where(step), name)

    namespace = _namespace_once(spark, folder, "append", fill)
    orders = sources.scan_table(spark, f"{namespace}.orders")
    return _plain(orders.select(*_given_columns(spark, folder, "orders")))


def _parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    given = fixtures.given_tables(spark, folder)
    path = _folder_once(
        spark, folder, "lineitem", lambda to: sinks.write_parquet(given["lineitem"], to)
    )
    lines = sources.scan_parquet(spark, path)
    return _plain(lines.select(*_given_columns(spark, folder, "lineitem")))


def _mart_not_null(spark: SparkSession, folder: str) -> DataFrame:
    mart = plans.sales_summary(fixtures.given_tables(spark, folder))
    return operators.not_null_failures(mart, NOT_NULL_COLUMNS)


def _preview(spark: SparkSession, folder: str) -> DataFrame:
    orders = fixtures.given_tables(spark, folder)["orders"]
    columns = _given_columns(spark, folder, "orders")
    return _plain(plans.preview(orders.select(*columns), "o_orderkey"))


def _on_metrics(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: _rounded(report(fixtures.run_metrics(spark, folder)))


def _written_summary(spark: SparkSession, folder: str) -> DataFrame:
    report = operators.paired_report(fixtures.run_metrics(spark, folder))
    path = _folder_once(spark, folder, "summary", lambda to: sinks.write_summary_csv(report, to))
    return _rounded(operators.two_series(sources.read_summary_csv(spark, path)))


def _written_record(spark: SparkSession, folder: str) -> DataFrame:
    """Raw against loaded tables; every tenth order is missing from the loaded ones."""
    loaded = sources.catalog_sources(spark, _loaded_namespace(spark, folder))
    lossy = {**loaded, "orders": loaded["orders"].where("o_orderkey % 10 <> 0")}
    counts = operators.reconcile_counts(_raw_tables(spark, folder), lossy, TABLES)
    metrics, meta = fixtures.run_metrics(spark, folder), {"tables": len(TABLES)}
    record = operators.run_record(metrics, counts, _storage(spark, folder), meta)
    path = _folder_once(spark, folder, "record", lambda to: sinks.write_json(record, to))
    rows = spark.read.schema(record.schema).json(path)
    return rows.select(
        "section", "name", "variant", "metric", "run",
        F.round(F.col("value").cast("double"), 6).alias("value"),
    )


def _text_lines(spark: SparkSession, folder: str, table: str, column: str) -> str:
    """A folder with a column as lines of text, whose sizes SQL can tell."""
    texts = sources.scan_parquet(spark, f"{folder}/{table}.parquet").select(column)
    return _folder_once(spark, folder, f"lines of {table}", lambda to: texts.write.text(to))


def _storage(spark: SparkSession, folder: str) -> DataFrame:
    return operators.storage_report(
        spark,
        _text_lines(spark, folder, "documents", "text"),
        _text_lines(spark, folder, "pages", "html"),
    )


def _storage_of_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All raw files against all files of the loaded tables."""
    loaded = sources.catalog_sources(spark, _loaded_namespace(spark, folder))
    files = [file for table in TABLES for file in loaded[table].inputFiles()]
    roots = sorted({file.rsplit("/", 1)[0] for file in files})
    return operators.storage_report(spark, _raw_base(spark, folder, *TABLES), roots)


def _paired_by_names(spark: SparkSession, folder: str) -> DataFrame:
    """The report for the kinds of events and one that has no run."""
    metrics = fixtures.run_metrics(spark, folder)
    listed = metrics.select("query").distinct()
    names = listed.union(spark.createDataFrame([("never run",)], "query string"))
    return _rounded(operators.paired_report(metrics, names))


def _text_sizes(spark: SparkSession, folder: str) -> DataFrame:
    texts = sources.scan_parquet(spark, f"{folder}/documents.parquet")
    size = F.octet_length("text").cast("bigint")
    return texts.select("doc_id", size.alias("bytes"), readable_size(size).alias("size"))


#: The table that the partly loaded namespace lacks.
ABSENT = "supplier"


def entry(spark: SparkSession) -> DataFrame:
    """The sales mart over the smallest tables."""
    return queries()["sales_summary"](spark, SMOKE_FOLDER)


def queries() -> dict[str, Query]:
    text = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return {
        **text,
        # named queries, in the DataFrame API and as SQL text
        "q1_groupby": _packaged("q1_groupby"),
        "q1_groupby_df": _on_given(plans.pricing_summary),
        "q1_groupby_sql": _inline_sql,
        "q3_top10": _on_given(plans.top_unshipped_orders),
        "q3_top10_sql": _packaged("q3_top10"),
        "q6_discount": _on_given(plans.promotional_discount),
        "q6_discount_1996": _on_given(lambda t: plans.promotional_discount(t, **YEAR_1996)),
        "q6_discount_sql": _packaged("q6_discount"),
        "q6_discount_sql_1996": _packaged("q6_discount", YEAR_1996),
        "sales_summary": _on_given(plans.sales_summary),
        "sales_summary_sql": _packaged("sales_summary"),
        "sales_summary_table": _summary_table,
        "sales_summary_view": _summary_view,
        "sales_by_region_view": _lasting_view,
        # raw files
        **{f"tbl_scan_{table}": _raw_scan(table) for table in TABLES},
        "tbl_view_orders": _raw_view,
        "tbl_view_keys": _raw_views,
        "tbl_q3_top10": _on_raw(plans.top_unshipped_orders),
        "tbl_q6_discount_1996": _on_raw(lambda t: plans.promotional_discount(t, **YEAR_1996)),
        "tbl_sales_summary": _on_raw(plans.sales_summary),
        "q1_by_variant": _by_variant(plans.pricing_summary),
        # tables and files
        "loaded_q1_groupby": _on_loaded(plans.pricing_summary),
        "loaded_q3_top10": _on_loaded(plans.top_unshipped_orders),
        "loaded_q6_discount_1996": _on_loaded(
            lambda t: plans.promotional_discount(t, **YEAR_1996)
        ),
        "loaded_sales_summary": _on_loaded(plans.sales_summary),
        "table_replace_orders": _replace_table,
        "table_append_orders": _append_rows,
        "parquet_round_trip_lineitem": _parquet_round_trip,
        "top_orders_preview": _preview,
        # checks
        "row_counts": lambda spark, folder: operators.row_counts(
            fixtures.given_tables(spark, folder)
        ),
        "row_count_reconcile": _reconcile,
        "row_count_reconcile_partly": _reconcile_partly,
        "table_counts": _table_counts,
        "mart_not_null": _mart_not_null,
        "contract_failures": lambda spark, folder: operators.contract_failures(
            fixtures.given_tables(spark, folder)
        ),
        # reports
        "run_summary": _on_metrics(operators.run_summary),
        "run_times": _on_metrics(operators.run_times),
        "paired_report": _on_metrics(operators.paired_report),
        "paired_report_by_names": _paired_by_names,
        "single_query_report": _on_metrics(
            lambda metrics: operators.single_query_report(metrics, "view")
        ),
        "two_series_report": _written_summary,
        "run_record": _written_record,
        "readable_text_sizes": _text_sizes,
        "storage_report": _storage,
        "storage_report_tables": _storage_of_tables,
    }


# --- the same in SQL over the given tables ----------------------------------


def _money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(15,2))"


_NET = f"{_money('l_extendedprice')} * (1 - {_money('l_discount')})"

_Q1 = f"""
    SELECT l_returnflag, l_linestatus,
           CAST(SUM({_money('l_quantity')}) AS DOUBLE) AS sum_qty,
           CAST(SUM({_money('l_extendedprice')}) AS DOUBLE) AS sum_base_price,
           ROUND(CAST(SUM({_money('l_discount')}) AS DOUBLE)
                 / NULLIF(COUNT(l_discount), 0), 6) AS avg_disc,
           COUNT(*) AS count_order
    FROM lineitem
    GROUP BY l_returnflag, l_linestatus
"""

_Q3 = f"""
    SELECT l_orderkey AS orderkey,
           CAST(SUM({_NET}) AS DOUBLE) AS revenue,
           CAST(o_orderdate AS DATE) AS orderdate,
           CAST(0 AS INTEGER) AS shippriority
    FROM customer
    JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING'
      AND CAST(o_orderdate AS DATE) < DATE '1995-03-15'
      AND CAST(l_shipdate AS DATE) > DATE '1995-03-15'
    GROUP BY l_orderkey, CAST(o_orderdate AS DATE)
    ORDER BY SUM({_NET}) DESC, orderdate, orderkey
    LIMIT 10
"""


def _q6(year: int) -> str:
    return f"""
    SELECT CAST(SUM({_money('l_extendedprice')} * {_money('l_discount')}) AS DOUBLE) AS revenue
    FROM lineitem
    WHERE CAST(l_shipdate AS DATE) >= DATE '{year}-01-01'
      AND CAST(l_shipdate AS DATE) < DATE '{year + 1}-01-01'
      AND {_money('l_discount')} BETWEEN 0.05 AND 0.07
      AND {_money('l_quantity')} < 24
"""


_MART = f"""
    SELECT r_name AS region_name, n_name AS nation_name,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus,
           CAST(SUM({_NET}) AS DOUBLE) AS total_revenue,
           CAST(SUM({_money('l_quantity')}) AS DOUBLE) AS total_quantity,
           COUNT(DISTINCT o_orderkey) AS order_count
    FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name, n_name, CAST(o_orderdate AS DATE), o_orderstatus
"""

_PART_SUPPLIERS = """
    (SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem)
"""


# The declared columns that the given tables lack.
_ABSENT_COLUMNS = {
    "c_address", "c_phone", "c_comment", "o_clerk", "o_comment", "l_commitdate",
    "l_receiptdate", "l_shipinstruct", "l_shipmode", "l_comment", "p_mfgr",
    "p_container", "p_comment", "s_address", "s_phone", "s_comment",
    "ps_availqty", "ps_supplycost", "ps_comment", "n_comment", "r_comment",
}


def _all_rows(table: str) -> str:
    """The given columns of a table in the declared types, decimals as DOUBLE."""
    columns = []
    for name in SCHEMAS[table].fieldNames():
        if name in _ABSENT_COLUMNS:
            continue
        kind = SCHEMAS[table][name].dataType
        if name == "o_shippriority":
            columns.append("CAST(0 AS INTEGER) AS o_shippriority")
        elif isinstance(kind, DecimalType):
            columns.append(f"CAST({_money(name)} AS DOUBLE) AS {name}")
        elif isinstance(kind, DateType):
            columns.append(f"CAST({name} AS DATE) AS {name}")
        else:
            columns.append(f"CAST({name} AS {kind.simpleString()}) AS {name}")
    origin = _PART_SUPPLIERS if table == "partsupp" else table
    return f"SELECT {', '.join(columns)} FROM {origin}"


def _count(table: str) -> str:
    origin = _PART_SUPPLIERS if table == "partsupp" else table
    return f"SELECT '{table}' AS table_name, COUNT(*) AS n FROM {origin}"


_COUNTS = " UNION ALL ".join(_count(table) for table in TABLES)

_METRICS = """
    (SELECT event_type AS query,
            CASE WHEN user_id % 2 = 0 THEN 'csv' ELSE 'iceberg' END AS variant,
            event_id AS run, value AS sec, user_id AS row_count
     FROM events) AS metrics
"""

_SUMMARY = f"""
    SELECT query, variant, COUNT(*) AS runs, ROUND(AVG(sec), 6) AS avg_sec,
           ROUND(MIN(sec), 6) AS min_sec, ROUND(MAX(sec), 6) AS max_sec,
           ROUND(STDDEV_POP(sec), 6) AS stdev_sec,
           ARG_MIN(row_count, run) AS row_count
    FROM {_METRICS}
    GROUP BY query, variant
"""


def _side(statistic: str, side: str) -> str:
    return f"{statistic}(sec) FILTER (WHERE variant = '{side}')"


_AVERAGES = ", ".join(
    f"ROUND({_side('AVG', side)}, 6) AS {side}_avg_sec" for side in ("csv", "iceberg")
)

_PAIRED = f"""
    SELECT query, {_AVERAGES},
           ROUND(NULLIF({_side('AVG', 'csv')}, 0) / NULLIF({_side('AVG', 'iceberg')}, 0), 6)
               AS speedup,
           ROUND({_side('MIN', 'csv')}, 6) AS csv_min_sec,
           ROUND({_side('MIN', 'iceberg')}, 6) AS iceberg_min_sec,
           ROUND({_side('MAX', 'csv')}, 6) AS csv_max_sec,
           ROUND({_side('MAX', 'iceberg')}, 6) AS iceberg_max_sec,
           ROUND({_side('STDDEV_POP', 'csv')}, 6) AS csv_stdev_sec,
           ROUND({_side('STDDEV_POP', 'iceberg')}, 6) AS iceberg_stdev_sec,
           CASE WHEN COUNT(*) FILTER (WHERE variant = 'csv') > 0
                THEN ARG_MIN(row_count, run) FILTER (WHERE variant = 'csv')
                ELSE ARG_MIN(row_count, run) FILTER (WHERE variant = 'iceberg')
           END AS row_count
    FROM {_METRICS}
    GROUP BY query
"""

# A line of text takes its bytes and one more; a NULL is an empty line.
_LINES = """
    SELECT (SELECT CAST(SUM(COALESCE(strlen(text), 0) + 1) AS BIGINT) FROM documents)
               AS csv_bytes,
           (SELECT CAST(SUM(COALESCE(strlen(html), 0) + 1) AS BIGINT) FROM pages)
               AS iceberg_bytes
"""

_RECORD = f"""
    WITH summary AS ({_SUMMARY}),
    counts AS (
        SELECT table_name, n,
               CASE WHEN table_name = 'orders'
                    THEN (SELECT COUNT(*) FROM orders WHERE o_orderkey % 10 <> 0) ELSE n
               END AS kept
        FROM ({_COUNTS})
    )
    SELECT 'queries' AS section, query AS name, variant, metric,
           CAST(NULL AS BIGINT) AS run, value
    FROM (SELECT query, variant,
                 UNNEST(['runs', 'avg_sec', 'min_sec', 'max_sec', 'stdev_sec', 'row_count'])
                     AS metric,
                 UNNEST([CAST(runs AS DOUBLE), avg_sec, min_sec, max_sec, stdev_sec,
                         CAST(row_count AS DOUBLE)]) AS value
          FROM summary)
    UNION ALL
    SELECT 'queries', query, variant, 'times_sec', run, ROUND(sec, 6) FROM {_METRICS}
    UNION ALL
    SELECT 'row_counts', table_name, CAST(NULL AS VARCHAR), UNNEST(['csv', 'iceberg', 'diff']),
           CAST(NULL AS BIGINT),
           UNNEST([CAST(n AS DOUBLE), CAST(kept AS DOUBLE), CAST(n - kept AS DOUBLE)])
    FROM counts
    UNION ALL
    SELECT 'storage', 'all', CAST(NULL AS VARCHAR),
           UNNEST(['csv_bytes', 'iceberg_bytes', 'compression_ratio']), CAST(NULL AS BIGINT),
           UNNEST([CAST(csv_bytes AS DOUBLE), CAST(iceberg_bytes AS DOUBLE),
                   ROUND(csv_bytes / NULLIF(iceberg_bytes, 0), 6)])
    FROM ({_LINES})
    UNION ALL
    SELECT 'meta', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'tables',
           CAST(NULL AS BIGINT), CAST({len(TABLES)} AS DOUBLE)
"""

_NOT_NULL = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, COUNT(*) FILTER (WHERE {name} IS NULL) AS failures FROM mart"
    for name in NOT_NULL_COLUMNS
)


def _contract() -> str:
    def row(table: str, column: str, rule: str, failures: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
            f"'{rule}' AS rule, ({failures}) AS failures"
        )

    rows = []
    for table, column, accepted in ACCEPTED_VALUES:
        listed = ", ".join(f"'{value}'" for value in accepted)
        broken = f"SELECT COUNT(*) FROM {table} WHERE {column} NOT IN ({listed})"
        rows.append(row(table, column, "accepted_values", broken))
    for table, column, low, high in ACCEPTED_RANGES:
        broken = f"SELECT COUNT(*) FROM {table} WHERE {_money(column)} NOT BETWEEN {low} AND {high}"
        rows.append(row(table, column, "accepted_values", broken))
    for table, key in PRIMARY_KEYS.items():
        broken = (
            f"SELECT COUNT(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING COUNT(*) > 1)"
        )
        rows.append(row(table, key, "unique", broken))
    for child, key, parent, target in FOREIGN_KEYS:
        broken = (
            f"SELECT COUNT(*) FROM {child} ANTI JOIN {parent} ON {key} = {target} "
            f"WHERE {key} IS NOT NULL"
        )
        rows.append(row(child, key, "relationship", broken))
    return " UNION ALL ".join(rows)


_SIZE = "strlen(text)"


def _readable(size: str) -> str:
    steps = " ".join(
        f"WHEN {size} < {1024 ** (power + 1)} "
        f"THEN printf('%.2f {unit}', {size} / CAST({1024 ** power} AS DOUBLE))"
        for power, unit in enumerate(("B", "KB", "MB", "GB"))
    )
    return f"CASE {steps} ELSE printf('%.2f TB', {size} / CAST({1024 ** 4} AS DOUBLE)) END"


def oracle_sql() -> dict[str, str]:
    text = dict(llm.oracle_sql()) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        text["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {
        **text,
        "q1_groupby": _Q1,
        "q1_groupby_df": _Q1,
        "q1_groupby_sql": _Q1,
        "q3_top10": _Q3,
        "q3_top10_sql": _Q3,
        "q6_discount": _q6(1994),
        "q6_discount_1996": _q6(1996),
        "q6_discount_sql": _q6(1994),
        "q6_discount_sql_1996": _q6(1996),
        "sales_summary": _MART,
        "sales_summary_sql": _MART,
        "sales_summary_table": _MART,
        "sales_summary_view": _MART,
        "sales_by_region_view": f"""
            SELECT region_name,
                   CAST(SUM(CAST(total_revenue AS DECIMAL(38, 4))) AS DOUBLE) AS total_revenue,
                   CAST(SUM(order_count) AS BIGINT) AS order_count
            FROM ({_MART}) GROUP BY region_name
        """,
        **{f"tbl_scan_{table}": _all_rows(table) for table in TABLES},
        "tbl_view_orders": f"""
            SELECT o_orderstatus, COUNT(*) AS n,
                   CAST(SUM({_money('o_totalprice')}) AS DOUBLE) AS total
            FROM orders GROUP BY o_orderstatus
        """,
        "tbl_view_keys": " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, COUNT(*) AS n, "
            f"CAST(SUM({SCHEMAS[table].fields[0].name}) AS BIGINT) AS keys FROM "
            + (_PART_SUPPLIERS if table == "partsupp" else table)
            for table in TABLES
        ),
        "tbl_q3_top10": _Q3,
        "tbl_q6_discount_1996": _q6(1996),
        "tbl_sales_summary": _MART,
        "q1_by_variant": f"""
            SELECT q.*, v.variant FROM ({_Q1}) AS q
            CROSS JOIN (VALUES ('csv'), ('iceberg')) AS v(variant)
        """,
        "loaded_q1_groupby": _Q1,
        "loaded_q3_top10": _Q3,
        "loaded_q6_discount_1996": _q6(1996),
        "loaded_sales_summary": _MART,
        "table_replace_orders": f"""
            SELECT *, CAST(YEAR(o_orderdate) AS INTEGER) AS order_year
            FROM ({_all_rows('orders')})
        """,
        "table_append_orders": _all_rows("orders"),
        "parquet_round_trip_lineitem": _all_rows("lineitem"),
        "top_orders_preview": f"{_all_rows('orders')} ORDER BY o_orderkey LIMIT 5",
        "row_counts": _COUNTS,
        "row_count_reconcile": f"""
            SELECT table_name, n AS csv, n AS iceberg, CAST(0 AS BIGINT) AS diff, true AS listed
            FROM ({_COUNTS})
        """,
        "row_count_reconcile_partly": f"""
            SELECT table_name, n AS csv, CASE WHEN table_name <> '{ABSENT}' THEN n END AS iceberg,
                   CASE WHEN table_name <> '{ABSENT}' THEN CAST(0 AS BIGINT) END AS diff
            FROM ({_COUNTS})
        """,
        "table_counts": f"""
            SELECT table_name, CASE WHEN table_name <> '{ABSENT}' THEN n END AS n
            FROM ({_COUNTS})
        """,
        "mart_not_null": f"WITH mart AS ({_MART}) {_NOT_NULL}",
        "contract_failures": _contract(),
        "run_summary": _SUMMARY,
        "run_times": f"SELECT query, variant, run, ROUND(sec, 6) AS sec FROM {_METRICS}",
        "paired_report": _PAIRED,
        "paired_report_by_names": f"""
            SELECT names.query, report.* EXCLUDE (query)
            FROM (SELECT event_type AS query FROM events
                  UNION SELECT 'never run') AS names
            LEFT JOIN ({_PAIRED}) AS report ON names.query = report.query
        """,
        "single_query_report": f"""
            SELECT CASE variant WHEN 'csv' THEN 'CSV' ELSE 'Iceberg' END AS source,
                   avg_sec, row_count AS rows
            FROM ({_SUMMARY}) WHERE query = 'view'
        """,
        "two_series_report": f"SELECT query, {_AVERAGES} FROM {_METRICS} GROUP BY query",
        "run_record": _RECORD,
        "readable_text_sizes": f"""
            SELECT doc_id, CAST({_SIZE} AS BIGINT) AS bytes, {_readable(_SIZE)} AS size
            FROM documents
        """,
        "storage_report": f"""
            SELECT csv_bytes, iceberg_bytes, {_readable('csv_bytes')} AS csv_size,
                   {_readable('iceberg_bytes')} AS iceberg_size,
                   csv_bytes / NULLIF(iceberg_bytes, 0) AS compression_ratio
            FROM ({_LINES})
        """,
    }
