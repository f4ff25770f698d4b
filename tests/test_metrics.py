"""Reports over run metrics."""

import json
import math
import statistics
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart import operators, sinks
from lakemart.sources import read_summary_csv

METRICS = "query string, variant string, run int, sec double, row_count bigint"


def metrics(spark, *rows):
    return spark.createDataFrame(list(rows), METRICS)


@pytest.fixture
def sample(spark):
    return metrics(
        spark,
        ("a", "csv", 1, 3.0, 4), ("a", "csv", 0, 1.0, 5), ("a", "csv", 2, 2.0, 6),
        ("a", "iceberg", 0, 0.5, 7),
        ("b", "iceberg", 0, 0.0, 1), ("b", "csv", 0, 2.0, None),
        ("c", "iceberg", 1, 4.0, 9), ("c", "iceberg", 0, 2.0, 8),
    )


def test_run_summary(sample):
    found = {(row.query, row.variant): row for row in operators.run_summary(sample).collect()}
    three = found["a", "csv"]
    assert (three.runs, three.avg_sec, three.min_sec, three.max_sec) == (3, 2.0, 1.0, 3.0)
    assert math.isclose(three.stdev_sec, statistics.pstdev([1, 2, 3]))
    assert three.row_count == 5
    one = found["a", "iceberg"]
    assert (one.runs, one.stdev_sec, one.row_count) == (1, 0.0, 7)


def test_run_times_come_in_order(sample):
    found = [tuple(row) for row in operators.run_times(sample).collect()]
    assert found == sorted(found)
    assert [row[3] for row in found if row[:2] == ("a", "csv")] == [1.0, 3.0, 2.0]


def test_paired_report_columns_and_guards(spark, sample):
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "query string")
    report = operators.paired_report(sample, names)
    # The columns of the report and their order.
    assert report.columns == [
        "query", "csv_avg_sec", "iceberg_avg_sec", "speedup", "csv_min_sec", "iceberg_min_sec",
        "csv_max_sec", "iceberg_max_sec", "csv_stdev_sec", "iceberg_stdev_sec", "row_count",
    ]
    found = {row.query: row for row in report.collect()}
    assert set(found) == {"a", "b", "c", "d"}
    assert found["a"].speedup == 4.0 and found["a"].row_count == 5
    assert found["b"].speedup is None and found["b"].iceberg_avg_sec == 0.0
    assert found["b"].row_count is None
    assert found["c"].csv_avg_sec is None and found["c"].speedup is None
    assert found["c"].iceberg_avg_sec == 3.0 and found["c"].row_count == 8
    assert all(value is None for value in tuple(found["d"])[1:])
    assert {row.query for row in operators.paired_report(sample).collect()} == {"a", "b", "c"}


def test_single_query_report(sample):
    found = sorted(tuple(row) for row in operators.single_query_report(sample, "a").collect())
    assert found == [("CSV", 2.0, 5), ("Iceberg", 0.5, 7)]
    assert operators.single_query_report(sample, "none").isEmpty()


def test_summary_csv_and_its_two_series(spark, sample, tmp_path):
    report = operators.paired_report(sample)
    path = str(tmp_path / "summary")
    sinks.write_summary_csv(report, path)
    again = read_summary_csv(spark, path)
    assert again.columns == report.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, report.collect()))
    series = sorted(tuple(row) for row in operators.two_series(again).collect())
    assert series == [("a", 2.0, 0.5), ("b", 2.0, 0.0), ("c", None, 3.0)]


def test_run_record_as_json(spark, sample, tmp_path):
    counts = spark.createDataFrame(
        [("orders", 10, 9, 1)], "table_name string, csv bigint, iceberg bigint, diff bigint"
    )
    storage = spark.createDataFrame(
        [(300, 100, 3.0)], "csv_bytes bigint, iceberg_bytes bigint, compression_ratio double"
    )
    record = operators.run_record(sample, counts, storage, {"mode": "both", "warmup": 1})
    sinks.write_json(record, str(tmp_path / "record"))
    found = defaultdict(dict)
    for row in spark.read.text(str(tmp_path / "record")).collect():
        item = json.loads(row.value)
        key = (item["name"], item["variant"], item["metric"], item["run"])
        found[item["section"]][key] = item["value"]
    assert found["meta"] == {
        (None, None, "mode", None): "both", (None, None, "warmup", None): "1"
    }
    assert found["row_counts"]["orders", None, "diff", None] == "1"
    assert found["storage"]["all", None, "compression_ratio", None] == "3.0"
    assert found["queries"]["a", "csv", "avg_sec", None] == "2.0"
    times = [found["queries"]["a", "csv", "times_sec", run] for run in range(3)]
    assert times == ["1.0", "3.0", "2.0"]


seconds = st.floats(0, 100, allow_nan=False).map(lambda value: round(value, 3))
runs = st.tuples(st.sampled_from("ab"), st.sampled_from(["csv", "iceberg"]), seconds)


@settings(max_examples=10, deadline=None)
@given(st.lists(runs, min_size=1, max_size=30))
def test_statistics_equal_pythons(spark, drawn):
    groups = defaultdict(list)
    rows = []
    for query, variant, sec in drawn:
        rows.append((query, variant, len(groups[query, variant]), sec, len(rows)))
        groups[query, variant].append(sec)
    report = {row.query: row for row in operators.paired_report(metrics(spark, *rows)).collect()}
    for (query, variant), times in groups.items():
        row = report[query]
        assert math.isclose(row[f"{variant}_avg_sec"], statistics.fmean(times), abs_tol=1e-9)
        assert row[f"{variant}_min_sec"] == min(times)
        assert row[f"{variant}_max_sec"] == max(times)
        spread = statistics.pstdev(times)
        assert math.isclose(row[f"{variant}_stdev_sec"], spread, abs_tol=1e-6)
