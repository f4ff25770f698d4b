"""The eight table schemas and the contract stated for them."""

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KEY = LongType()
WHOLE = IntegerType()
AMOUNT = DecimalType(15, 2)
TEXT = StringType()
DAY = DateType()


def _columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


# Names, order and types of the columns in the raw files.
SCHEMAS: dict[str, StructType] = {
    "customer": _columns(
        c_custkey=KEY, c_name=TEXT, c_address=TEXT, c_nationkey=KEY,
        c_phone=TEXT, c_acctbal=AMOUNT, c_mktsegment=TEXT, c_comment=TEXT,
    ),
    "orders": _columns(
        o_orderkey=KEY, o_custkey=KEY, o_orderstatus=TEXT, o_totalprice=AMOUNT,
        o_orderdate=DAY, o_orderpriority=TEXT, o_clerk=TEXT,
        o_shippriority=WHOLE, o_comment=TEXT,
    ),
    "lineitem": _columns(
        l_orderkey=KEY, l_partkey=KEY, l_suppkey=KEY, l_linenumber=WHOLE,
        l_quantity=AMOUNT, l_extendedprice=AMOUNT, l_discount=AMOUNT,
        l_tax=AMOUNT, l_returnflag=TEXT, l_linestatus=TEXT, l_shipdate=DAY,
        l_commitdate=DAY, l_receiptdate=DAY, l_shipinstruct=TEXT,
        l_shipmode=TEXT, l_comment=TEXT,
    ),
    "part": _columns(
        p_partkey=KEY, p_name=TEXT, p_mfgr=TEXT, p_brand=TEXT, p_type=TEXT,
        p_size=WHOLE, p_container=TEXT, p_retailprice=AMOUNT, p_comment=TEXT,
    ),
    "supplier": _columns(
        s_suppkey=KEY, s_name=TEXT, s_address=TEXT, s_nationkey=KEY,
        s_phone=TEXT, s_acctbal=AMOUNT, s_comment=TEXT,
    ),
    "partsupp": _columns(
        ps_partkey=KEY, ps_suppkey=KEY, ps_availqty=WHOLE,
        ps_supplycost=AMOUNT, ps_comment=TEXT,
    ),
    "nation": _columns(n_nationkey=KEY, n_name=TEXT, n_regionkey=KEY, n_comment=TEXT),
    "region": _columns(r_regionkey=KEY, r_name=TEXT, r_comment=TEXT),
}

TABLES: tuple[str, ...] = tuple(SCHEMAS)

# Raw lines end in a delimiter, which reads as one more, empty, field.
TRAILING = StructField("_trailing", TEXT)

# The contract stated for the source tables.
PRIMARY_KEYS = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "nation": "n_nationkey",
    "region": "r_regionkey",
}
FOREIGN_KEYS = (
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
)
ACCEPTED_VALUES = (
    ("orders", "o_orderstatus", ("O", "F", "P")),
    ("lineitem", "l_returnflag", ("R", "A", "N")),
    ("lineitem", "l_linestatus", ("O", "F")),
)
ACCEPTED_RANGES = (("lineitem", "l_discount", "0.00", "0.10"),)
