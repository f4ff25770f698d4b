"""Quality checks, row counts, storage and session."""

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from lakemart import fixtures, operators, plans, sinks, sources
from lakemart.plans.mart import NOT_NULL_COLUMNS
from lakemart.schemas import TABLES
from lakemart.session import DEFAULTS, build_spark, drop_cached, shared_folder
from tables import customer, line, make, nation, order, region


def by_key(df, width):
    """The last column, or all that are left, by the first ones."""
    rest = {tuple(row)[:width]: tuple(row)[width:] for row in df.collect()}
    return {key: values[0] if len(values) == 1 else values for key, values in rest.items()}


def test_mart_has_no_null(spark, small):
    mart = plans.sales_summary(fixtures.given_tables(spark, small))
    found = by_key(operators.not_null_failures(mart, NOT_NULL_COLUMNS), 1)
    assert found == {(name,): 0 for name in NOT_NULL_COLUMNS}


def test_planted_nulls_are_found(spark):
    tables = {
        "region": make(spark, "region", region(1, None)),
        "nation": make(spark, "nation", nation(1, "JAPAN")),
        "customer": make(spark, "customer", customer(1)),
        "orders": make(spark, "orders", order(1, 1), order(2, 1, None)),
        "lineitem": make(spark, "lineitem", line(1, None), line(2)),
    }
    found = by_key(operators.not_null_failures(plans.sales_summary(tables), NOT_NULL_COLUMNS), 1)
    assert found == {
        ("region_name",): 2, ("nation_name",): 0, ("o_orderdate",): 1, ("o_orderstatus",): 0,
        ("total_revenue",): 1, ("total_quantity",): 0, ("order_count",): 0,
    }


def test_an_empty_mart_fails_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert by_key(operators.not_null_failures(empty, ["a", "b"]), 1) == {("a",): 0, ("b",): 0}


def test_contract_failures_are_counted(spark):
    def flagged(key, **more):
        return line(key, l_partkey=1, l_suppkey=1, l_returnflag="A", l_linestatus="F") | more

    tables = {
        "region": make(spark, "region", region(1, "ASIA"), region(1, "ASIA"), region(None, "X")),
        "nation": make(
            spark, "nation", nation(1, "JAPAN"), nation(2, "INDIA", 9), nation(3, "X", None)
        ),
        "customer": make(spark, "customer", customer(1), customer(2, None)),
        "orders": make(
            spark, "orders",
            order(1, 1), order(1, 1), order(2, 8, status="X"), order(3, 8, status=None),
        ),
        "lineitem": make(
            spark, "lineitem",
            flagged(1), flagged(7), flagged(7, l_returnflag="Q"), flagged(None, l_linestatus="P"),
            flagged(2, l_discount=Decimal("0.11")), flagged(2, l_discount=None, l_partkey=5),
        ),
        "part": make(spark, "part", {"p_partkey": 1}),
        "supplier": make(spark, "supplier", {"s_suppkey": 1}),
    }
    found = by_key(operators.contract_failures(tables), 3)
    assert len(found) == 14
    assert {key: n for key, n in found.items() if n} == {
        ("orders", "o_orderstatus", "accepted_values"): 1,
        ("lineitem", "l_returnflag", "accepted_values"): 1,
        ("lineitem", "l_linestatus", "accepted_values"): 1,
        ("lineitem", "l_discount", "accepted_values"): 1,
        ("orders", "o_orderkey", "unique"): 1,
        ("region", "r_regionkey", "unique"): 1,
        ("orders", "o_custkey", "relationship"): 2,
        ("lineitem", "l_orderkey", "relationship"): 2,
        ("lineitem", "l_partkey", "relationship"): 1,
        ("nation", "n_regionkey", "relationship"): 1,
    }


def test_lost_rows_show_in_the_reconciliation(spark, tiny):
    given = fixtures.given_tables(spark, tiny)
    loaded = dict(given)
    loaded["orders"] = given["orders"].where("o_orderkey > 2")
    loaded["region"] = given["region"].where("false")
    report = operators.reconcile_counts(given, loaded, TABLES)
    assert report.columns == ["table_name", "csv", "iceberg", "diff"]
    found = {row.table_name: tuple(row)[1:] for row in report.collect()}
    assert set(found) == set(TABLES)
    assert found["orders"] == (1500, 1497, 3) and found["region"] == (5, 0, 5)
    assert all(found[name][2] == 0 for name in TABLES if name not in ("orders", "region"))


def test_the_reconciliation_tolerates_a_missing_side(spark, tiny, new_name, tmp_path):
    given = fixtures.given_tables(spark, tiny)
    namespace = new_name("partly")
    sinks.create_namespace(spark, namespace)
    sinks.create_or_replace(given["nation"], f"{namespace}.nation", str(tmp_path))
    loaded = sources.catalog_sources(spark, namespace, ["nation", "region"])
    report = operators.reconcile_counts(given, loaded, ["nation", "region"])
    assert by_key(report, 1) == {("nation",): (25, 25, 0), ("region",): (5, None, None)}
    lost = sources.raw_sources(spark, str(tmp_path / "nowhere"))
    report = operators.reconcile_counts(lost, {"nation": given["nation"]}, ["nation", "region"])
    assert by_key(report, 1) == {("nation",): (None, 25, None), ("region",): (None, None, None)}


def test_other_errors_of_a_source_are_raised(spark):
    broken = sources.Sources(["t"], lambda _: spark.sql("SELECT no_such_column"))
    with pytest.raises(AnalysisException, match="no_such_column"):
        operators.reconcile_counts(broken, broken, ["t"])


def test_counts_tolerate_a_missing_table(spark, new_name, tmp_path):
    namespace = new_name("counts")
    sinks.create_namespace(spark, namespace)
    sinks.create_or_replace(spark.range(7), f"{namespace}.nation", str(tmp_path))
    found = by_key(operators.table_counts(spark, namespace, ["nation", "region"]), 1)
    assert found == {("nation",): 7, ("region",): None}
    assert by_key(operators.table_counts(spark, namespace, ["part"]), 1) == {("part",): None}


def disk_bytes(folder):
    files = [file for file in Path(folder).rglob("*") if file.is_file()]
    return sum(file.stat().st_size for file in files if file.name[0] not in "._")


def test_storage_report_adds_up_nested_files(spark, tiny, tmp_path):
    given = fixtures.given_tables(spark, tiny)
    raw = fixtures.write_raw(given, str(tmp_path / "raw"), ["orders", "lineitem"])
    lake = str(tmp_path / "lake")
    for name in ("orders", "lineitem"):
        sinks.write_parquet(given[name], f"{lake}/deep/{name}")
    row = operators.storage_report(spark, raw, lake).first()
    assert (row.csv_bytes, row.iceberg_bytes) == (disk_bytes(raw), disk_bytes(lake))
    assert row.csv_size == f"{row.csv_bytes / 1024:.2f} KB"
    assert row.compression_ratio == row.csv_bytes / row.iceberg_bytes


def test_storage_ratio_without_tables_is_null(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "lake").mkdir()
    (tmp_path / "raw" / "a.tbl").write_text("x" * 2000)
    row = operators.storage_report(spark, str(tmp_path / "raw"), str(tmp_path / "lake")).first()
    assert tuple(row) == (2000, 0, "1.95 KB", "0.00 B", None)


def test_storage_report_tolerates_a_missing_root(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.tbl").write_text("x" * 2000)
    raw, absent = str(tmp_path / "raw"), str(tmp_path / "absent")
    row = operators.storage_report(spark, raw, absent).first()
    assert tuple(row) == (2000, None, "1.95 KB", None, None)
    row = operators.storage_report(spark, [raw, absent], raw).first()
    assert tuple(row) == (None, 2000, None, "1.95 KB", None)


def test_session_settings_and_cache(spark):
    again = build_spark(shuffle_partitions=4, conf={"spark.sql.parquet.mergeSchema": "true"})
    assert again.conf.get("spark.sql.parquet.mergeSchema") == "true"
    build_spark(shuffle_partitions=4)
    for key, value in DEFAULTS.items():
        assert spark.conf.get(key) == value
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    spark.range(3).createOrReplaceTempView("cached_numbers")
    spark.catalog.cacheTable("cached_numbers")
    drop_cached(spark)
    assert not spark.catalog.isCached("cached_numbers")


class _Session:
    """Just the settings, which decide where shared data goes."""

    def __init__(self, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}


def test_shared_folder_follows_the_cluster(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second and first.startswith(f"{root}/lakemart-")
    set_folder = _Session(spark__checkpoint__dir="hdfs:///shared/", spark__sql__warehouse__dir="w")
    assert shared_folder(set_folder).startswith("hdfs:///shared/lakemart-")
    unset = _Session(spark__sql__warehouse__dir="hdfs:///warehouse")
    assert shared_folder(unset).startswith("hdfs:///warehouse/lakemart-")


def test_nothing_in_the_library_uses_a_local_temporary_folder():
    package = Path(operators.__file__).parents[1]
    assert not [file for file in package.rglob("*.py") if "tempfile" in file.read_text()]


def test_a_second_call_writes_nothing(spark, tiny):
    import __spark_entry__ as entry_point

    def files():
        root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
        return sorted(str(file) for file in root.rglob("*.parquet"))

    names = ("sales_summary_table", "table_replace_orders", "table_append_orders", "table_counts")
    queries = entry_point.queries()
    first = {name: rows_of(queries[name](spark, tiny)) for name in names}
    written = files()
    assert {name: rows_of(queries[name](spark, tiny)) for name in names} == first
    assert files() == written


def rows_of(df):
    return sorted(map(repr, df.collect()))
