"""Nearest neighbours with an inverted multi-index (operator 5).

Method. Both halves of the vectors are quantised apart, each by its own k-means,
so a pair of centroids names a cell. A query goes through the cells by the sum of
its inner products with the two centroids, best first, by the multi-sequence walk
with a heap, until the cells hold ``share`` of all vectors. The vectors of these
cells are ranked again by their exact inner product.

The centroids are fitted, and ``share`` is set, on a sample of at most
``sample_rows`` vectors, the first by hash of the id: the least share that finds
``target`` of the exact neighbours within the sample. Every vector is indexed.
Vectors without structure need a large share; clustered ones a small one.

Cells are put in blocks of about equal size. A cell with very many vectors, such
as copies of one, is spread over several blocks by hash. A query goes once to
each block that holds one of its cells and returns at most ``k`` rows from it.

Defined cases. Vectors that are null, zero, hold a null or a number that isn't
finite, have another length than most of the sample, or have no id take no part.
Of rows that repeat an id the least vector counts. Equal inner products go to the
smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, complete_runs, import_on_executors

K = 20
EVERY = 20
SAMPLE_ROWS = 20_000
TARGET = 0.95
TRIALS = 200
MOST_BLOCK = 1 << 16


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector (double) of the rows that take part, apart from their length."""
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"),
        vectors[vector_col].cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    other = F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    return rows.where(finite & other).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row."""
    return np.argmin((centroids**2).sum(axis=1) - 2 * rows @ centroids.T, axis=1)


def kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    distinct = np.unique(rows, axis=0)
    centroids = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(rounds):
        own = nearest(rows, centroids)
        n = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


class MultiIndex:
    """The two sets of centroids; cell ``a * width + b`` belongs to the pair (a, b)."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.first = kmeans(sample[:, : self.half], k)
        self.second = kmeans(sample[:, self.half :], k)
        self.width = len(self.second)
        self.cells = len(self.first) * self.width

    def cell(self, rows: np.ndarray) -> np.ndarray:
        a = nearest(rows[:, : self.half], self.first)
        return a * self.width + nearest(rows[:, self.half :], self.second)

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Cells by falling sum of inner products."""
        a, b = self.first @ query[: self.half], self.second @ query[self.half :]
        first, second = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[first].tolist(), b[second].tolist()
        heap, reached = [(-a[0] - b[0], 0, 0)], [0] * len(a)
        # row i has given its cells up to reached[i]; a cell follows its left and upper neighbours
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(first[i]) * self.width + int(second[j])
            reached[i] = j + 1
            if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (-a[i] - b[j + 1], i, j + 1))
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (-a[i + 1] - b[j], i + 1, j))

    def probed(self, query: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
        """The first cells that hold ``wanted`` vectors together."""
        out, held = [], 0
        for cell in self.walk(query):
            if sizes[cell]:
                out.append(cell)
                held += sizes[cell]
                if held >= wanted:
                    break
        return out


def needed_share(index: MultiIndex, sample: np.ndarray, k: int, target: float) -> float:
    """The share of vectors to look at for ``target`` recall, by brute force within the sample."""
    cells = index.cell(sample)
    sizes = np.bincount(cells, minlength=index.cells)
    step = max(1, len(sample) // TRIALS)
    places = []
    for i in range(0, len(sample), step):
        scores = sample @ sample[i]
        scores[i] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(k, len(sample) - 1)]
        seen = np.zeros(index.cells)
        order = np.fromiter(index.walk(sample[i]), dtype=np.int64)
        seen[order] = np.cumsum(sizes[order])
        places.append(seen[cells[best]])
    found = np.sort(np.concatenate(places)) if places else np.zeros(0)
    if not len(found):
        return 1.0
    return float(found[min(len(found) - 1, int(np.ceil(target * len(found))))]) / len(sample)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cells(index: MultiIndex) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = index.cell(_matrix(batch.column("vector")))
                yield batch.append_column("cell", pa.array(cells, pa.int32()))

    return assign


def _probes(index: MultiIndex, sizes: np.ndarray, wanted: float, first: np.ndarray, parts: np.ndarray) -> Callable:
    """A row for each block that a query visits, with the cells to look at there."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                blocks, rows, cells = [], [], []
                for i, query in enumerate(_matrix(part.column("vector"))):
                    held: dict[int, list[int]] = {}
                    for cell in index.probed(query, sizes, wanted):
                        for block in range(first[cell], first[cell] + parts[cell]):
                            held.setdefault(block, []).append(cell)
                    for block, inside in held.items():
                        blocks.append(block)
                        rows.append(i)
                        cells.append(inside)
                taken = part.take(pa.array(rows, pa.int64()))
                yield pa.record_batch(
                    {
                        "block": pa.array(blocks, pa.int64()),
                        "is_query": pa.array(np.ones(len(rows), np.int32)),
                        "vec_id": taken.column("vec_id"),
                        "vector": taken.column("vector"),
                        "cells": pa.array(cells, pa.list_(pa.int32())),
                    }
                )

    return probe


_ROUTED = "block long, is_query int, vec_id long, vector array<double>, cells array<int>"


def _ranked(k: int) -> Callable:
    """Entries of a block come before its queries; each query gets its ``k`` best of its cells."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, parts = None, None, []
        for rows, _ in complete_runs(batches, ["block", "is_query", "vec_id"]):
            starts = rows.column("block").to_numpy()
            cuts = np.flatnonzero(np.append(True, starts[1:] != starts[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(starts))):
                if starts[a] != block:
                    block, held, parts = starts[a], None, []
                part = rows.slice(a, b - a)
                queries = part.column("is_query").to_numpy() == 1
                if not queries.all():
                    parts.append(part.filter(pa.array(~queries)))
                if queries.any() and parts:
                    if held is None:
                        held = _entries(parts)
                    yield from _best(part.filter(pa.array(queries)), *held, k)

    return rank


def _entries(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = pa.Table.from_batches(parts).combine_chunks()
    ids = rows.column("vec_id").to_numpy()
    cells = rows.column("cells").combine_chunks().flatten().to_numpy()
    vectors = _matrix(rows.column("vector").combine_chunks())
    order = np.lexsort([ids, cells])
    return ids[order], cells[order], np.ascontiguousarray(vectors[order])


def _best(queries: pa.RecordBatch, ids: np.ndarray, cells: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, queries.num_rows, 256):
        part = queries.slice(at, 256)
        out_query, out_id, out_score = [], [], []
        for query_id, query, inside in zip(
            part.column("vec_id").to_numpy(), _matrix(part.column("vector")), part.column("cells")
        ):
            wanted = np.sort(inside.values.to_numpy())
            lows, highs = np.searchsorted(cells, wanted), np.searchsorted(cells, wanted, "right")
            look = np.concatenate([np.arange(a, b) for a, b in zip(lows, highs)])
            look = look[ids[look] != query_id]
            if not len(look):
                continue
            rough = vectors[look] @ query
            if len(look) > k:
                least = np.partition(rough, len(rough) - k)[len(rough) - k]
                slack = 1e-12 * np.abs(vectors[look]).max() * np.abs(query).sum()
                look = look[rough >= least - slack]
            # row by row in one order, so that equal vectors have equal scores
            exact = (vectors[look] * query).sum(axis=1)
            best = np.lexsort([ids[look], -exact])[:k]
            out_query.append(np.full(len(best), query_id))
            out_id.append(ids[look][best])
            out_score.append(exact[best])
        if out_query:
            yield pa.record_batch(
                {
                    "query_id": np.concatenate(out_query),
                    "vec_id": np.concatenate(out_id),
                    "score": np.concatenate(out_score),
                }
            )


def nearest_by_multi_index(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    every: int = EVERY,
    sample_rows: int = SAMPLE_ROWS,
    target: float = TARGET,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` best by inner product.

    Queries are the vectors whose id is divisible by ``every``.
    """
    spark = vectors.sparkSession
    import_on_executors(spark)
    steps = Steps(spark)
    nothing = "query_id long, rank int, vec_id long, score double"
    rows = steps.keep(usable(vectors, id_col, vector_col))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], nothing)
    lengths = [len(v) for v in sample.column("vector")]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    rows = rows.where(F.size("vector") == length)
    fitted = np.array([v for v in sample.column("vector").to_pylist() if len(v) == length])
    n = rows.count()
    # about 32 vectors in a cell
    width = int(np.clip(2 ** round(np.log2(max(np.sqrt(n / 32), 2))), 2, 256))
    index = MultiIndex(fitted if length > 1 else np.hstack([fitted, 0 * fitted]), width)
    if length == 1:
        rows = rows.withColumn("vector", F.concat("vector", F.array(F.lit(0.0))))
    share = needed_share(index, fitted if length > 1 else np.hstack([fitted, 0 * fitted]), k, target)

    placed = steps.keep(rows.mapInArrow(_cells(index), "vec_id long, vector array<double>, cell int"))
    sizes = np.zeros(index.cells, dtype=np.int64)
    for row in placed.groupBy("cell").count().collect():
        sizes[row["cell"]] = row["count"]
    most = int(np.clip(n // 16, 512, MOST_BLOCK))
    # cells in turn fill a block; a cell that is larger has blocks of its own
    parts = np.maximum(1, -(-sizes // most))
    block, filled, first = 0, 0, np.zeros(index.cells, dtype=np.int64)
    for cell, size in enumerate(sizes.tolist()):
        if filled and filled + size > most:
            block, filled = block + 1, 0
        first[cell] = block
        filled += size
        if parts[cell] > 1:
            block, filled = block + int(parts[cell]), 0
    table = spark.createDataFrame(
        [(int(c), int(first[c]), int(parts[c])) for c in np.flatnonzero(sizes)],
        "cell int, first long, parts int",
    )
    # one row for each cell in use, at most 256 * 256
    entries = placed.join(F.broadcast(table), "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts")).alias("block"),
        F.lit(0).alias("is_query"),
        "vec_id",
        "vector",
        F.array("cell").alias("cells"),
    )
    wanted = max(share * n, 4 * (k + 1))
    queries = placed.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "vector")
    probes = queries.repartition("vec_id").mapInArrow(_probes(index, sizes, wanted, first, parts), _ROUTED)
    order = ["block", "is_query", "vec_id"]
    routed = entries.union(probes).repartition("block").sortWithinPartitions(*order)
    found = routed.mapInArrow(_ranked(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
