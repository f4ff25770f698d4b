"""One query over the raw and the loaded tables (T5)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def choose_variants(mode: str, raw: Tables, loaded: Tables) -> dict[str, Tables]:
    """The table sets a mode asks for: ``csv``, ``iceberg`` or ``both``."""
    variants = {"csv": raw, "iceberg": loaded}
    if mode == "both":
        return variants
    if mode not in variants:
        raise ValueError(f"mode must be csv, iceberg or both, not {mode!r}")
    return {mode: variants[mode]}


def by_variant(
    query: Callable[[Tables], DataFrame], variants: Mapping[str, Tables]
) -> DataFrame:
    """The rows of a query on each table set, marked with the variant."""
    parts = [
        query(tables).withColumn("variant", F.lit(name))
        for name, tables in variants.items()
    ]
    return reduce(DataFrame.unionByName, parts)
