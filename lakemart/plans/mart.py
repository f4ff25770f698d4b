"""The sales mart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakemart.functions import net_revenue

# The mart columns that must never be NULL.
NOT_NULL_COLUMNS = (
    "region_name",
    "nation_name",
    "o_orderdate",
    "o_orderstatus",
    "total_revenue",
    "total_quantity",
    "order_count",
)


def sales_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Revenue, quantity and distinct orders by region, nation, day, status.

    Line items are summed per order before the join, which is exact whether or
    not keys are unique, since sums distribute over an inner join. It takes an
    order with very many lines down to one row per map task. The join to
    lineitem comes last: its partitioning by order key then also serves the
    distinct count, so lineitem and orders are shuffled by that key just once.
    Nation and region carry no broadcast hint; Spark broadcasts what it finds
    small enough and shuffles the rest.
    """
    per_order = tables["lineitem"].groupBy("l_orderkey").agg(
        F.sum(net_revenue(F.col("l_extendedprice"), F.col("l_discount"))).alias("revenue"),
        F.sum("l_quantity").alias("quantity"),
    )
    located = (
        tables["customer"]
        .join(tables["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(tables["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        tables["orders"]
        .join(located, F.col("o_custkey") == F.col("c_custkey"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(
            F.col("r_name").alias("region_name"),
            F.col("n_name").alias("nation_name"),
            "o_orderdate",
            "o_orderstatus",
        )
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("quantity").cast(DecimalType(25, 2)).alias("total_quantity"),
            F.countDistinct("o_orderkey").alias("order_count"),
        )
    )
