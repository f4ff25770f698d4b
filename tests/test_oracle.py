"""Every registered query against its SQL on DuckDB over the same files."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()

SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER",
    "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


def normalised(rows):
    """Rows as sortable text with numbers to 9 digits."""

    def text(value):
        if value is None:
            return "NULL"
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.9g}"
        return str(value)

    return sorted(tuple(text(value) for value in row) for row in rows)


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for file in Path(small).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    text = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}
    assert set(QUERIES) - set(ORACLE) - text == {"storage_report_tables"}


def test_storage_of_all_tables(spark, small):
    row = QUERIES["storage_report_tables"](spark, small).first()
    assert row.csv_bytes > row.iceberg_bytes > 0
    assert row.compression_ratio == row.csv_bytes / row.iceberg_bytes


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, duck, small, name):
    actual = QUERIES[name](spark, small)
    expected = duck.execute(ORACLE[name])
    kinds = {column[0]: str(column[1]) for column in expected.description}
    assert {c: SPARK_TO_DUCK[kind] for c, kind in actual.dtypes} == kinds
    columns = sorted(kinds)
    order = [column[0] for column in expected.description]
    rows = [tuple(row[order.index(c)] for c in columns) for row in expected.fetchall()]
    got = [tuple(row) for row in actual.select(*columns).collect()]
    assert normalised(got) == normalised(rows)


def test_entry_runs(spark):
    result = entry_point.entry(spark)
    assert result.count() == 1465
