"""Small hand-made tables in the declared schemas."""

import datetime as dt
from decimal import Decimal

from lakemart.schemas import SCHEMAS


def make(spark, table, *rows):
    """A table from dicts; columns not given are NULL."""
    schema = SCHEMAS[table]
    names = schema.fieldNames()
    assert all(set(row) <= set(names) for row in rows)
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def line(order, price="100.00", discount="0.00", quantity="1.00", shipped="1996-01-02", **more):
    def amount(text):
        return None if text is None else Decimal(text)

    return {
        "l_orderkey": order,
        "l_extendedprice": amount(price),
        "l_discount": amount(discount),
        "l_quantity": amount(quantity),
        "l_shipdate": None if shipped is None else dt.date.fromisoformat(shipped),
        **more,
    }


def order(key, customer, day="1995-01-01", status="O", priority=0):
    return {
        "o_orderkey": key,
        "o_custkey": customer,
        "o_orderdate": None if day is None else dt.date.fromisoformat(day),
        "o_orderstatus": status,
        "o_shippriority": priority,
    }


def customer(key, nation=1, segment="BUILDING"):
    return {"c_custkey": key, "c_nationkey": nation, "c_mktsegment": segment}


def nation(key, name, region=1):
    return {"n_nationkey": key, "n_name": name, "n_regionkey": region}


def region(key, name):
    return {"r_regionkey": key, "r_name": name}
