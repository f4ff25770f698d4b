"""Order, ties, NULLs, repeated and hot keys in the named queries."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal
from functools import partial

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart import fixtures, plans
from lakemart.sources import raw_sources
from tables import customer, line, make, nation, order, region

Q3_PARAMS: dict = {}  # the defaults that come with the text
YEAR_1996 = {"start": dt.date(1996, 1, 1), "end": dt.date(1997, 1, 1)}


def rows(df):
    return [tuple(row) for row in df.collect()]


def sql_form(spark, name, tables, params=None):
    return plans.run_sql(spark, plans.packaged_queries()[name], tables, params)


# --- pricing summary ---------------------------------------------------------


def test_pricing_summary_is_ordered_and_typed(spark, small):
    result = plans.pricing_summary(fixtures.given_tables(spark, small))
    assert result.dtypes == [
        ("l_returnflag", "string"), ("l_linestatus", "string"),
        ("sum_qty", "decimal(25,2)"), ("sum_base_price", "decimal(25,2)"),
        ("avg_disc", "decimal(19,6)"), ("count_order", "bigint"),
    ]
    keys = [row[:2] for row in rows(result)]
    assert keys == sorted(keys) and len(keys) == 6


def test_pricing_summary_skips_null_amounts(spark):
    lines = make(
        spark, "lineitem",
        line(1, None, "0.05", None, l_returnflag="A", l_linestatus="F"),
        line(2, "10.00", None, "3.00", l_returnflag="A", l_linestatus="F"),
        line(3, None, None, None, l_returnflag=None, l_linestatus="O"),
    )
    assert rows(plans.pricing_summary({"lineitem": lines})) == [
        (None, "O", None, None, None, 1),
        ("A", "F", Decimal("3.00"), Decimal("10.00"), Decimal("0.050000"), 2),
    ]


def test_empty_input_gives_no_group(spark):
    assert rows(plans.pricing_summary({"lineitem": make(spark, "lineitem")})) == []


# --- top unshipped orders ----------------------------------------------------


def test_top_orders_are_ordered_and_limited(spark, small):
    given = fixtures.given_tables(spark, small)
    result = plans.top_unshipped_orders(given)
    assert result.dtypes == [
        ("orderkey", "bigint"), ("revenue", "decimal(38,4)"),
        ("orderdate", "date"), ("shippriority", "int"),
    ]
    found = rows(result)
    assert len(found) == 10
    assert found == sorted(found, key=lambda row: (-row[1], row[2], row[0]))
    everything = rows(plans.top_unshipped_orders(given, top=1000))
    assert len(everything) == 87 and everything[:10] == found
    assert rows(sql_form(spark, "q3_top10", given, Q3_PARAMS)) == found


def test_top_orders_ties_dates_and_null_keys(spark):
    tables = {
        "customer": make(
            spark, "customer", customer(1), customer(2, segment="MACHINERY"), customer(None)
        ),
        "orders": make(
            spark, "orders",
            order(10, 1, "1995-03-14"), order(11, 1, "1995-03-01"), order(12, 1, "1995-03-14"),
            order(13, 1, "1995-03-15"), order(14, 2), order(15, None), order(None, 1),
            order(16, 1, None),
        ),
        "lineitem": make(
            spark, "lineitem",
            *[line(key, "100.00", "0.10", shipped="1995-03-16") for key in range(10, 16)],
            line(10, "5.00", shipped="1995-03-15"), line(None), line(16), line(99),
            line(12, None, "0.10", shipped="1995-04-01"), line(11, "1.00", None),
        ),
    }
    value = Decimal("90.0000")
    expected = [
        (11, value, dt.date(1995, 3, 1), 0),
        (10, value, dt.date(1995, 3, 14), 0),
        (12, value, dt.date(1995, 3, 14), 0),
    ]
    assert rows(plans.top_unshipped_orders(tables)) == expected
    assert rows(sql_form(spark, "q3_top10", tables, Q3_PARAMS)) == expected
    assert rows(plans.top_unshipped_orders(tables, top=2)) == expected[:2]


# --- discount revenue --------------------------------------------------------


def test_discount_revenue_bounds(spark):
    inside = [
        line(1, "10.00", "0.05", "23.99", "1996-01-01"),
        line(2, "10.00", "0.07", "1.00", "1996-12-31"),
    ]
    outside = [
        line(3, "10.00", "0.04", "1.00", "1996-06-01"),
        line(4, "10.00", "0.08", "1.00", "1996-06-01"),
        line(5, "10.00", "0.06", "24.00", "1996-06-01"),
        line(6, "10.00", "0.06", "1.00", "1997-01-01"),
        line(7, "10.00", "0.06", "1.00", "1995-12-31"),
        line(8, "10.00", None, "1.00", "1996-06-01"),
        line(9, "10.00", "0.06", "1.00", None),
    ]
    tables = {"lineitem": make(spark, "lineitem", *inside, *outside)}
    result = plans.promotional_discount(tables, **YEAR_1996)
    assert result.dtypes == [("revenue", "decimal(38,4)")]
    assert rows(result) == [(Decimal("1.2000"),)]
    assert rows(sql_form(spark, "q6_discount", tables, YEAR_1996)) == [(Decimal("1.2000"),)]


def test_discount_revenue_without_a_match_is_one_null(spark, small):
    assert rows(plans.promotional_discount(fixtures.given_tables(spark, small))) == [(None,)]
    empty = {"lineitem": make(spark, "lineitem")}
    assert rows(plans.promotional_discount(empty)) == [(None,)]


# --- sales mart --------------------------------------------------------------

DECLARED_MART = """
    SELECT r_name, n_name, o_orderdate, o_orderstatus,
           sum(l_extendedprice * (1 - l_discount)), sum(l_quantity),
           count(DISTINCT o_orderkey)
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
"""


def test_mart_types_and_size(spark, small):
    mart = plans.sales_summary(fixtures.given_tables(spark, small))
    assert mart.dtypes == [
        ("region_name", "string"), ("nation_name", "string"),
        ("o_orderdate", "date"), ("o_orderstatus", "string"),
        ("total_revenue", "decimal(38,4)"), ("total_quantity", "decimal(25,2)"),
        ("order_count", "bigint"),
    ]
    assert mart.count() == 14153
    assert mart.agg(F.sum("order_count")).first()[0] == 14743


def test_sql_and_dataframe_marts_agree(spark, small):
    given = fixtures.given_tables(spark, small)
    text, frame = sql_form(spark, "sales_summary", given), plans.sales_summary(given)
    assert text.dtypes == frame.dtypes
    assert sorted(rows(text), key=str) == sorted(rows(frame), key=str)


def test_mart_groups_by_name_and_drops_orders_without_lines(spark):
    tables = {
        "region": make(spark, "region", region(1, "ASIA"), region(2, "ASIA")),
        "nation": make(
            spark, "nation", nation(1, "JAPAN", 1), nation(2, "JAPAN", 2), nation(3, "CHINA", 9)
        ),
        "customer": make(spark, "customer", customer(1, 1), customer(2, 2), customer(3, 3)),
        "orders": make(spark, "orders", order(1, 1), order(2, 2), order(3, 1), order(4, 3)),
        "lineitem": make(
            spark, "lineitem", line(1), line(1), line(2, "50.00", "0.50", "2.00"), line(4)
        ),
    }
    day = dt.date(1995, 1, 1)
    expected = [("ASIA", "JAPAN", day, "O", Decimal("225.0000"), Decimal("4.00"), 2)]
    assert rows(plans.sales_summary(tables)) == expected


few = st.one_of(st.none(), st.integers(1, 3))
amounts = st.one_of(st.none(), st.decimals("-9", "9", places=2))
names = st.sampled_from(["A", "B", None])


@settings(max_examples=12, deadline=None)
@given(data=st.data())
def test_mart_equals_the_declared_form_for_any_keys(spark, data):
    """Repeated, missing and NULL keys on every side of the joins."""

    def draw(make_row, *parts):
        return data.draw(st.lists(st.tuples(*parts).map(lambda p: make_row(*p)), max_size=8))

    def item(key, price, discount, quantity):
        return {"l_orderkey": key, "l_extendedprice": price, "l_discount": discount,
                "l_quantity": quantity}

    drawn = {
        "region": draw(region, few, names),
        "nation": draw(nation, few, names, few),
        "customer": draw(customer, few, few),
        "orders": draw(partial(order, day="1995-01-01"), few, few),
        "lineitem": draw(item, few, amounts, amounts, amounts),
    }
    tables = {name: make(spark, name, *made) for name, made in drawn.items()}
    with duckdb.connect() as duck:
        for name, df in tables.items():
            duck.register(name, df.toArrow())
        wanted = duck.execute(DECLARED_MART).fetchall()
    assert sorted(rows(plans.sales_summary(tables)), key=str) == sorted(wanted, key=str)


def test_one_order_with_a_third_of_all_lines(spark, small):
    given = fixtures.given_tables(spark, small)
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey"))
    tables = dict(given, lineitem=given["lineitem"].withColumn("l_orderkey", hot))
    by_order = defaultdict(Decimal)
    for row in tables["lineitem"].select("l_orderkey", "l_quantity").toLocalIterator():
        by_order[row[0]] += row[1]
    known = {row[0] for row in tables["orders"].select("o_orderkey").collect()}
    mart = plans.sales_summary(tables).agg(F.sum("total_quantity"), F.sum("order_count")).first()
    assert mart[0] == sum(value for key, value in by_order.items() if key in known)
    assert mart[1] == len(known & set(by_order))


# --- preview -----------------------------------------------------------------


def test_preview_keeps_all_columns_and_the_first_keys(spark, tiny):
    orders = fixtures.given_tables(spark, tiny)["orders"]
    shown = plans.preview(orders, "o_orderkey")
    assert shown.columns == orders.columns
    keys = sorted(row[0] for row in orders.select("o_orderkey").collect())
    assert [row.o_orderkey for row in shown.collect()] == keys[:5]


# --- query text and variants -------------------------------------------------


def test_queries_from_files_with_either_kind_of_braces(spark, tiny, tmp_path):
    (tmp_path / "b.sql").write_text(
        "SELECT count(*) AS n FROM {{orders}} WHERE o_orderkey >= :low\n"
    )
    (tmp_path / "a.sql").write_text("SELECT count(n_name) AS n FROM {nation}")
    (tmp_path / "notes.txt").write_text("not a query")
    loaded = plans.load_queries(tmp_path)
    assert list(loaded) == ["a", "b"]
    given = fixtures.given_tables(spark, tiny)
    assert rows(plans.run_sql(spark, loaded["a"], given)) == [(25,)]
    assert rows(plans.run_sql(spark, loaded["b"], given, {"low": 0})) == [(1500,)]
    with pytest.raises(KeyError):
        plans.run_sql(spark, "SELECT * FROM {invoices}", given)


def test_packaged_and_named_queries_have_the_same_names():
    assert set(plans.packaged_queries()) == set(plans.NAMED_QUERIES)


def test_variants_give_equal_rows(spark, tiny, tmp_path):
    given = fixtures.given_tables(spark, tiny)
    raw = raw_sources(spark, fixtures.write_raw(given, str(tmp_path)))
    both = plans.choose_variants("both", raw, given)
    assert list(both) == ["csv", "iceberg"]
    assert list(plans.choose_variants("csv", raw, given)) == ["csv"]
    with pytest.raises(ValueError):
        plans.choose_variants("orc", raw, given)
    for query in (*plans.NAMED_QUERIES.values(), partial(plans.promotional_discount, **YEAR_1996)):
        marked = plans.by_variant(query, both)
        sides = defaultdict(list)
        for row in marked.collect():
            sides[row.variant].append(str(row[:-1]))
        assert sorted(sides["csv"]) == sorted(sides["iceberg"]) and sides["csv"]


# --- query text ----------------------------------------------------------------


def test_every_packaged_text_runs_as_it_is(spark, small):
    tables = fixtures.given_tables(spark, small)
    for name, text in plans.packaged_queries().items():
        found = rows(plans.run_sql(spark, text, tables))
        assert sorted(map(repr, found)) == sorted(map(repr, rows(plans.NAMED_QUERIES[name](tables))))


def test_parameters_of_a_text_can_all_be_set(spark, small):
    tables = fixtures.given_tables(spark, small)
    text = plans.packaged_queries()["q3_top10"]
    assert len(rows(plans.run_sql(spark, text, tables, {"top": 3}))) == 3
    wide = {"low": Decimal("0.00"), "high": Decimal("0.10"), "quantity": 30, **YEAR_1996}
    text = plans.packaged_queries()["q6_discount"]
    assert rows(plans.run_sql(spark, text, tables, wide)) == rows(
        plans.promotional_discount(tables, **wide)
    )


def test_braces_around_other_text_stay(spark):
    numbers = spark.range(2)
    text = "SELECT '{abc}' AS a, '{{word}}' AS b, '{ \"x\": {1} }' AS c, count(*) AS n FROM {t}"
    assert rows(plans.run_sql(spark, text, {"t": numbers})) == [
        ("{abc}", "{{word}}", '{ "x": {1} }', 2)
    ]
    assert rows(plans.run_sql(spark, "SELECT '{abc}' AS a", {"t": numbers})) == [("{abc}",)]
    assert rows(plans.run_sql(spark, "SELECT count(*) AS n FROM {{ t }}", {"t": numbers})) == [(2,)]
