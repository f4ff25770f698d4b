from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions import (
    discount_amount,
    guarded_ratio,
    net_revenue,
    readable_size,
    safe_ratio,
)


def plain_size(size):
    for unit in ("B", "KB", "MB", "GB"):
        if size < 1024:
            return f"{size:.2f} {unit}"
        size /= 1024
    return f"{size:.2f} TB"


def sizes_in_spark(spark, sizes):
    rows = spark.createDataFrame([(size,) for size in sizes], "size bigint")
    return [row[1] for row in rows.select("size", readable_size(F.col("size"))).collect()]


def test_readable_size_at_unit_borders_and_halves(spark):
    sizes = [0, 1, 1023, 1024, 1029, 1152, 1408, 1664, 10**6, 1024**2 - 1, 1024**2, 1024**3 - 1]
    sizes += [1024**3, 1024**4 - 1, 1024**4, 3 * 1024**4 + 17, 5000 * 1024**4, 11145550186]
    assert sizes_in_spark(spark, sizes) == [plain_size(size) for size in sizes]


def test_readable_size_of_null(spark):
    assert sizes_in_spark(spark, [None]) == [None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 2**50), min_size=1, max_size=200))
def test_readable_size_is_python_formatting(spark, sizes):
    assert sizes_in_spark(spark, sizes) == [plain_size(size) for size in sizes]


def test_ratios_guard_zero_and_null(spark):
    rows = [(6.0, 3.0), (6.0, 0.0), (0.0, 3.0), (None, 3.0), (6.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    found = df.select(
        safe_ratio(F.col("a"), F.col("b")), guarded_ratio(F.col("a"), F.col("b"))
    ).collect()
    assert [row[0] for row in found] == [2.0, None, 0.0, None, None]
    assert [row[1] for row in found] == [2.0, None, None, None, None]


def test_revenue_types_and_values(spark):
    df = spark.createDataFrame(
        [(Decimal("19.99"), Decimal("0.07"))], "p decimal(15,2), d decimal(15,2)"
    ).select(
        net_revenue(F.col("p"), F.col("d")).alias("net"),
        discount_amount(F.col("p"), F.col("d")).alias("off"),
    )
    assert df.dtypes == [("net", "decimal(32,4)"), ("off", "decimal(31,4)")]
    assert tuple(df.first()) == (Decimal("18.5907"), Decimal("1.3993"))
