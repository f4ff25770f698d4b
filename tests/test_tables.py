"""Table life cycle in the session catalog."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakemart import fixtures, plans, sinks
from lakemart.schemas import SCHEMAS, TABLES
from lakemart.sources import catalog_sources, list_tables, scan_parquet, scan_table

SAMPLE = StructType([StructField("id", LongType()), StructField("name", StringType())])


@pytest.fixture
def namespace(spark, new_name):
    name = new_name("tables")
    sinks.create_namespace(spark, name)
    sinks.create_namespace(spark, name)
    return name


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_parquet_write_then_read(spark, tmp_path):
    path = str(tmp_path / "sample")
    for values in ([(9, "old")], [(1, "hello"), (2, "world")]):
        sinks.write_parquet(spark.createDataFrame(values, ["id", "value"]), path)
    assert rows(scan_parquet(spark, path)) == [(1, "hello"), (2, "world")]


def test_create_append_read_drop(spark, namespace, tmp_path):
    name = f"{namespace}.sample"
    for _ in range(2):
        sinks.create_table(spark, name, SAMPLE, str(tmp_path))
    assert scan_table(spark, name).schema == SAMPLE and scan_table(spark, name).isEmpty()
    sinks.append_rows(spark.createDataFrame([(1, "Alice")], SAMPLE), name)
    swapped = spark.createDataFrame([("Bob", 2)], "name string, id bigint")
    sinks.append_rows(swapped, name)
    assert rows(scan_table(spark, name)) == [(1, "Alice"), (2, "Bob")]
    assert [row.tableName for row in list_tables(spark, namespace).collect()] == ["sample"]
    sinks.drop_table(spark, name)
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError):
        sinks.append_rows(swapped, name)


def test_replace_takes_new_rows_and_a_new_schema(spark, namespace, tmp_path):
    name, root = f"{namespace}.t", str(tmp_path)
    sinks.create_or_replace(spark.range(5), name, root)
    earlier = scan_table(spark, name)
    sinks.create_or_replace(spark.range(3).select("id", F.lit("x").alias("tag")), name, root)
    assert rows(scan_table(spark, name)) == [(0, "x"), (1, "x"), (2, "x")]
    assert earlier.count() == 5
    assert [row.tableName for row in list_tables(spark, namespace).collect()] == ["t"]


def test_a_table_can_be_rebuilt_from_itself(spark, namespace, tmp_path):
    name, root = f"{namespace}.t", str(tmp_path)
    sinks.create_or_replace(spark.range(10), name, root)
    sinks.create_or_replace(scan_table(spark, name).where("id % 2 = 0"), name, root)
    assert rows(scan_table(spark, name)) == [(0,), (2,), (4,), (6,), (8,)]


def test_a_failed_write_leaves_the_old_table(spark, namespace, tmp_path):
    name, root = f"{namespace}.t", str(tmp_path)
    sinks.create_or_replace(spark.range(4), name, root)
    broken = spark.range(4).select(F.expr("id div (id - 2)").alias("id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.create_or_replace(broken, name, root)
    assert rows(scan_table(spark, name)) == [(0,), (1,), (2,), (3,)]


def test_an_empty_result_replaces_too(spark, namespace, tmp_path):
    name, root = f"{namespace}.t", str(tmp_path)
    sinks.create_or_replace(spark.range(4), name, root)
    sinks.create_or_replace(spark.range(4).where("id < 0"), name, root)
    assert scan_table(spark, name).isEmpty()


def test_default_folder_is_the_warehouse(spark, namespace):
    name = f"{namespace}.t"
    sinks.create_or_replace(spark.range(2), name)
    (file, *_) = scan_table(spark, name).inputFiles()
    assert spark.conf.get("spark.sql.warehouse.dir").split(":")[-1] in file
    assert file.endswith(".snappy.parquet")


def test_load_all_raw_tables(spark, tiny, tmp_path, new_name):
    given = fixtures.given_tables(spark, tiny)
    base = fixtures.write_raw(given, str(tmp_path / "raw"))
    namespace = new_name("load")
    names = sinks.load_raw(spark, base, namespace, root=str(tmp_path / "lake"))
    assert names == [f"{namespace}.{table}" for table in TABLES]
    loaded = catalog_sources(spark, namespace)
    assert list(loaded) == list(TABLES)
    for table in TABLES:
        assert loaded[table].dtypes == [
            (field.name, field.dataType.simpleString()) for field in SCHEMAS[table]
        ]
        assert loaded[table].exceptAll(given[table]).isEmpty()
        assert given[table].exceptAll(loaded[table]).isEmpty()


def test_a_model_as_table_and_as_view(spark, tiny, namespace, tmp_path):
    mart = plans.sales_summary(fixtures.given_tables(spark, tiny))
    table = sinks.materialize(mart, f"{namespace}.sales_summary", "table", str(tmp_path))
    view = sinks.materialize(mart, "mart_view", "view")
    assert table.dtypes == view.dtypes == mart.dtypes
    assert rows(table) == rows(view) == rows(mart)
    with pytest.raises(ValueError):
        sinks.materialize(mart, "other", "incremental")


def test_a_lasting_view(spark, namespace, tmp_path):
    sinks.create_or_replace(spark.range(4), f"{namespace}.t", str(tmp_path))
    name = f"{namespace}.even"
    for divisor in (3, 2):
        view = sinks.create_view(
            spark, name, f"SELECT id FROM {namespace}.t WHERE id % {divisor} = 0"
        )
    assert rows(view) == rows(spark.table(name)) == [(0,), (2,)]


def test_a_view_is_not_replaced_by_a_table(spark, namespace, tmp_path):
    sinks.create_or_replace(spark.range(4), f"{namespace}.t", str(tmp_path))
    name = f"{namespace}.v"
    sinks.create_view(spark, name, f"SELECT id FROM {namespace}.t")
    before = sorted(tmp_path.rglob("*.parquet"))
    with pytest.raises(ValueError, match="is a view"):
        sinks.create_or_replace(spark.range(9), name, str(tmp_path))
    assert scan_table(spark, name).count() == 4
    assert sorted(tmp_path.rglob("*.parquet")) == before
    assert {row.tableName for row in list_tables(spark, namespace).collect()} == {"t", "v"}


@pytest.mark.parametrize("failing", [1, 2])
def test_a_rename_that_fails_is_rolled_back(spark, namespace, tmp_path, monkeypatch, failing):
    from lakemart.sinks import tables

    name, root = f"{namespace}.t", str(tmp_path)
    sinks.create_or_replace(spark.range(4), name, root)
    rename, calls = tables._rename, []

    def flaky(spark, old, new):
        calls.append(new)
        if len(calls) == failing:
            raise OSError("lost the catalog")
        rename(spark, old, new)

    monkeypatch.setattr(tables, "_rename", flaky)
    with pytest.raises(OSError, match="lost the catalog"):
        sinks.create_or_replace(spark.range(9), name, root)
    assert scan_table(spark, name).count() == 4
    assert [row.tableName for row in list_tables(spark, namespace).collect()] == ["t"]
