"""Scans of raw files (S1, S2, S6) and reports in CSV."""

import datetime as dt
from decimal import Decimal

import pytest

from lakemart import fixtures
from lakemart.schemas import SCHEMAS, TABLES
from lakemart.sources import raw_sources, read_summary_csv, register_raw_views, scan_raw
from tables import make


@pytest.mark.parametrize("table", TABLES)
def test_round_trip_through_raw_files(spark, tiny, tmp_path, table):
    given = fixtures.given_tables(spark, tiny)
    base = fixtures.write_raw(given, str(tmp_path), [table])
    scanned = scan_raw(spark, base, table)
    assert scanned.dtypes == [(f.name, f.dataType.simpleString()) for f in SCHEMAS[table]]
    assert scanned.exceptAll(given[table]).isEmpty()
    assert given[table].exceptAll(scanned).isEmpty()


def test_raw_lines_end_in_a_delimiter(spark, tiny, tmp_path):
    given = fixtures.given_tables(spark, tiny)
    base = fixtures.write_raw(given, str(tmp_path), ["region"])
    lines = [row.value for row in spark.read.text(f"{base}/region.tbl").collect()]
    assert sorted(lines)[0].split("|") == ["0", "AFRICA", "", ""]


def test_single_file_and_malformed_lines(spark, tmp_path):
    lines = [
        "1|10|O|12.34|1995-02-03|1-URGENT|clerk|0|fine|",
        "2|10|O|1.005|not a day|||x||",
        "3||F||1995-02-30|2-HIGH|a \"quoted\" word|5|text|more|and more|",
        "4|11",
        "five|12|P|99999999999999999.00|1996-01-01|||||",
    ]
    (tmp_path / "orders.tbl").write_text("\n".join(lines) + "\n")
    found = scan_raw(spark, str(tmp_path), "orders").collect()
    assert len(found) == len(lines)
    assert found[0].o_totalprice == Decimal("12.34")
    assert found[0].o_orderdate == dt.date(1995, 2, 3)
    assert found[1].o_totalprice == Decimal("1.01")
    assert found[1].o_orderdate is None and found[1].o_shippriority is None
    assert found[1].o_orderpriority is None
    assert found[2].o_custkey is None and found[2].o_orderdate is None
    assert found[2].o_clerk == 'a "quoted" word' and found[2].o_comment == "text"
    assert found[3].o_custkey == 11 and found[3].o_orderstatus is None
    assert found[4].o_orderkey is None and found[4].o_totalprice is None
    assert found[4].o_orderstatus == "P"
    assert scan_raw(spark, str(tmp_path), "orders").count() == len(lines)


def test_views_are_registered_per_table(spark, tiny, tmp_path):
    given = fixtures.given_tables(spark, tiny)
    base = fixtures.write_raw(given, str(tmp_path))
    assert register_raw_views(spark, base) == [f"csv_{table}" for table in TABLES]
    for table in TABLES:
        assert spark.table(f"csv_{table}").count() == given[table].count()


def test_unknown_table_is_named(spark, tmp_path):
    with pytest.raises(KeyError, match="invoices"):
        raw_sources(spark, str(tmp_path))["invoices"]


def test_summary_csv_with_text_that_is_no_number(spark, tmp_path):
    (tmp_path / "summary.csv").write_text(
        "query,csv_avg_sec,iceberg_avg_sec,row_count\n"
        "a,1.5,,4\nb,n/a,2e-1,many\nc,, 3 ,10\n"
    )
    found = read_summary_csv(spark, str(tmp_path / "summary.csv")).orderBy("query")
    assert [kind for _, kind in found.dtypes] == ["string", "double", "double", "bigint"]
    assert [tuple(row) for row in found.collect()] == [
        ("a", 1.5, None, 4),
        ("b", None, 0.2, None),
        ("c", None, 3.0, 10),
    ]


def test_blanks_at_the_ends_of_a_text_are_kept(spark, tmp_path):
    given = {"region": make(spark, "region", {"r_regionkey": 1, "r_name": " x ", "r_comment": "  "})}
    base = fixtures.write_raw(given, str(tmp_path), ["region"])
    row = scan_raw(spark, base, "region").first()
    assert (row.r_name, row.r_comment) == (" x ", "  ")
