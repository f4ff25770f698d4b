"""Column expressions shared by the queries and reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units, each 1024 times the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")


def net_revenue(price: Column, discount: Column) -> Column:
    """Price after discount; DECIMAL(32,4) for DECIMAL(15,2) inputs."""
    return price * (F.lit(1) - discount)


def discount_amount(price: Column, discount: Column) -> Column:
    """The part of the price given away."""
    return price * discount


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b``, NULL where ``b`` is zero or either is NULL."""
    return F.try_divide(a, b)


def guarded_ratio(a: Column, b: Column) -> Column:
    """``a / b``, NULL where either side is NULL or zero."""
    return F.when((a != 0) & (b != 0), a / b)


def readable_size(size: Column) -> Column:
    """Bytes as text with two decimals, in steps of 1024 from B to TB."""
    result = None
    for power in reversed(range(len(SIZE_UNITS))):
        # Halves go to the even digit; format_string alone would round them up.
        scaled = F.bround(size.cast("double") / F.lit(float(1024**power)), 2)
        text = F.format_string(f"%.2f {SIZE_UNITS[power]}", scaled)
        if result is None:
            result = text
        else:
            result = F.when(size < F.lit(1024 ** (power + 1)), text).otherwise(result)
    return F.when(size.isNotNull(), result)
