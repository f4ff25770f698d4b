"""The named queries in the DataFrame API.

Constants are parameters; their defaults are those of the query set.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import discount_amount, net_revenue
from lakemart.plans.defaults import DEFAULTS
from lakemart.plans.mart import sales_summary

Tables = Mapping[str, DataFrame]


def pricing_summary(tables: Tables) -> DataFrame:
    """Quantity, price, discount and count by return flag and status.

    One pass with partial aggregation; a handful of rows are shuffled per task.
    """
    # fixed values: the grouping columns and the output names
    flags = ["l_returnflag", "l_linestatus"]
    totals = tables["lineitem"].groupBy(*flags).agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.sum("l_extendedprice").alias("sum_base_price"),
        F.avg("l_discount").alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"),
    )
    return totals.orderBy(*flags)


def top_unshipped_orders(
    tables: Tables,
    segment: str = DEFAULTS["segment"],
    cutoff: dt.date = DEFAULTS["cutoff"],
    top: int = DEFAULTS["top"],
) -> DataFrame:
    """Open orders of a segment with the most revenue yet to ship.

    The joined lines are summed task by task before they move, then by order.
    The join's own partitioning by order would serve the sums too, but then
    Spark may not split the join of an order with very many lines, as that
    breaks the partitioning. One struct as the key lifts this tie: it isn't the
    join's key, so the partial sums are shuffled, and adaptive execution may
    split such an order over many tasks. Order keys break ties, so the result is
    one and the same on every run.
    """
    customers = tables["customer"].where(F.col("c_mktsegment") == segment)
    orders = tables["orders"].where(F.col("o_orderdate") < F.lit(cutoff))
    unshipped = tables["lineitem"].where(F.col("l_shipdate") > F.lit(cutoff))
    due = net_revenue(F.col("l_extendedprice"), F.col("l_discount"))
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(unshipped, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.struct("l_orderkey", "o_orderdate", "o_shippriority").alias("key"))
        .agg(F.sum(due).alias("revenue"))
        # fixed values: the output names
        .select(
            F.col("key.l_orderkey").alias("orderkey"),
            "revenue",
            F.col("key.o_orderdate").alias("orderdate"),
            F.col("key.o_shippriority").alias("shippriority"),
        )
        .orderBy(F.desc("revenue"), F.asc("orderdate"), F.asc("orderkey"))
        .limit(top)
    )


def promotional_discount(
    tables: Tables,
    start: dt.date = DEFAULTS["start"],
    end: dt.date = DEFAULTS["end"],
    low: Decimal = DEFAULTS["low"],
    high: Decimal = DEFAULTS["high"],
    quantity: int = DEFAULTS["quantity"],
) -> DataFrame:
    """Price given away on small lines shipped in ``[start, end)``.

    Always one row, NULL if no line matches. All tests reach a typed scan.
    """
    shipped = F.col("l_shipdate")
    lines = tables["lineitem"].where(
        (shipped >= F.lit(start))
        & (shipped < F.lit(end))
        & F.col("l_discount").between(F.lit(low), F.lit(high))
        & (F.col("l_quantity") < quantity)
    )
    given = discount_amount(F.col("l_extendedprice"), F.col("l_discount"))
    return lines.agg(F.sum(given).alias("revenue"))


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by key, all columns; top-k per task, no full sort."""
    return df.select("*").orderBy(key).limit(rows)


NAMED_QUERIES = {
    "q1_groupby": pricing_summary,
    "q3_top10": top_unshipped_orders,
    "q6_discount": promotional_discount,
    "sales_summary": sales_summary,
}
