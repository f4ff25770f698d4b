"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import Steps


def components(edges: DataFrame, steps: Steps, most_rounds: int = 60) -> DataFrame:
    """Nodes of ``edges`` (a, b: long) with the least node of their component.

    Rounds of large-star and small-star steps turn the edges into stars around
    the least nodes; the number of rounds grows with the logarithm of the
    longest path. Each round is written to the shared folder. A node with very
    many neighbours is split by adaptive execution: its joins use a key that no
    earlier partitioning satisfies. Loops and repeated edges change nothing; no
    edges give no rows.
    """
    kept = steps.keep(_directed(edges))
    state = _state(kept)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = kept.union(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))
        kept = steps.keep(_directed(_stars(_stars(both, large=True), large=False)))
        before, state = state, _state(kept)
        if state == before:
            break
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    return kept.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        kept.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    # xxhash64 may be summed in decimals without overflow
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    row = edges.agg(F.count(F.lit(1)), total).first()
    return row[0], int(row[1] or 0)


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large: larger neighbours of each node go to its least; small: the smaller ones."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    least = least.select(F.struct(F.col("a")).alias("key"), "least")
    joined = edges.join(least, F.struct(edges["a"]) == least["key"])
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return joined.select(
        F.inline(
            F.array(
                F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                F.struct(F.col("a").alias("a"), F.col("least").alias("b")),
            )
        )
    )
