"""Data-quality checks that report failures as rows (V1 and the contract)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.schemas import ACCEPTED_RANGES, ACCEPTED_VALUES, FOREIGN_KEYS, PRIMARY_KEYS

Tables = Mapping[str, DataFrame]

_RULE = ("table_name", "column_name", "rule")


def not_null_failures(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """V1: ``(column_name, failures)``, all columns in a single pass."""
    return _count_failures(df, {name: F.col(name).isNull() for name in columns})


def contract_failures(tables: Tables) -> DataFrame:
    """Failures of the stated contract: ``(table_name, column_name, rule, failures)``.

    A NULL breaks no rule here.
    """
    value_rules: dict[str, dict[str, Column]] = {}
    for table, column, accepted in ACCEPTED_VALUES:
        value_rules.setdefault(table, {})[column] = ~F.col(column).isin(*accepted)
    for table, column, low, high in ACCEPTED_RANGES:
        inside = F.col(column).between(F.lit(Decimal(low)), F.lit(Decimal(high)))
        value_rules.setdefault(table, {})[column] = ~inside
    parts = [
        _labelled(_count_failures(tables[table], rules), table, "accepted_values")
        for table, rules in value_rules.items()
    ]
    parents = {(parent, target) for _, _, parent, target in FOREIGN_KEYS}
    parts += [
        _key_failures(tables, table, key)
        for table, key in sorted(parents | set(PRIMARY_KEYS.items()))
    ]
    return reduce(DataFrame.unionByName, parts)


def _count_failures(df: DataFrame, broken: Mapping[str, Column]) -> DataFrame:
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in broken.items()])
    return counts.unpivot([], list(broken), "column_name", "failures")


def _key_failures(tables: Tables, table: str, key: str) -> DataFrame:
    """Repeated values of a key, and rows of other tables whose reference has no such value.

    Parent and child keys are one list, counted per value: a column is shuffled
    once, without any join, and a value sends one row per task.
    """
    children = [(child, column) for child, column, *to in FOREIGN_KEYS if to == [table, key]]
    sides = [(table, key), *children]
    keys = [
        tables[name].select(F.col(column).alias("key"), F.lit(number).alias("side"))
        for number, (name, column) in enumerate(sides)
    ]
    per_key = (
        reduce(DataFrame.unionAll, keys)
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(*[F.count_if(F.col("side") == k).alias(f"n{k}") for k in range(len(sides))])
    )
    rules = {}
    if PRIMARY_KEYS.get(table) == key:
        rules[(table, key, "unique")] = F.count_if(F.col("n0") > 1)
    for k, (child, column) in enumerate(children, start=1):
        orphans = F.sum(F.when(F.col("n0") == 0, F.col(f"n{k}")))
        rules[(child, column, "relationship")] = F.coalesce(orphans, F.lit(0))
    failures = [
        F.struct(
            *[F.lit(text).alias(name) for text, name in zip(rule, _RULE)],
            count.cast("bigint").alias("failures"),
        )
        for rule, count in rules.items()
    ]
    return per_key.agg(F.array(*failures).alias("rules")).select(F.inline("rules"))


def _labelled(failures: DataFrame, table: str, rule: str) -> DataFrame:
    return failures.select(
        F.lit(table).alias("table_name"), "column_name", F.lit(rule).alias("rule"), "failures"
    )
