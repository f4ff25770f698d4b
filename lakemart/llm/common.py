"""Helpers shared by the operators: columns, written steps, batches, runs, words."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import shared_folder

#: Text handled at a time inside a task, in bytes.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def import_on_executors(spark: SparkSession) -> None:
    """Lets Python workers import this library from where the driver did.

    On a cluster the library is installed or sent with ``--py-files``; a folder
    that an executor doesn't have is skipped there.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` (long) and ``text``, where null counts as empty."""
    import_on_executors(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def fresh_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """The wanted column names, made longer until no column has them, in either case."""
    held, out = {name.lower() for name in taken}, []
    for name in wanted:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def remainder(id_col: str | Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; a null id counts as empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Steps:
    """Intermediate tables in a new shared folder; each is written once and reread.

    A lost executor then costs the tasks it ran, not the steps before.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.written = spark, shared_folder(spark), 0
        self.kept: list[tuple[str, DataFrame]] = []
        self.tables: list[str] = []

    def _path(self) -> str:
        self.written += 1
        return f"{self.folder}/step{self.written}"

    def _reread(self, path: str, df: DataFrame) -> DataFrame:
        self.kept.append((path, df))
        return df

    @contextmanager
    def _shuffles_removed(self) -> Iterator[None]:
        """Spark removes the shuffle files of what is written here once it is written."""
        conf = self.spark.conf
        before = conf.get(_REMOVE_SHUFFLES, None)
        conf.set(_REMOVE_SHUFFLES, "true")
        try:
            yield
        finally:
            if before is None:
                conf.unset(_REMOVE_SHUFFLES)
            else:
                conf.set(_REMOVE_SHUFFLES, before)

    def keep(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        path = self._path()
        with self._shuffles_removed():
            df.write.option("compression", codec).parquet(path)
        return self._reread(path, self.spark.read.schema(df.schema).parquet(path))

    def keep_by(self, df: DataFrame, column: str, buckets: int, codec: str = "zstd") -> DataFrame:
        """Kept in buckets by a column, so that grouping by it doesn't move the rows again."""
        name = f"lakemart_{self.folder.rpartition('-')[2]}_{self.written + 1}"
        path = self._path()
        with self._shuffles_removed():
            writer = df.write.option("compression", codec).option("path", path)
            writer.bucketBy(buckets, column).saveAsTable(name, format="parquet")
        self.tables.append(name)
        return self._reread(path, self.spark.table(name))

    def drop_all_but(self, *needed: DataFrame) -> None:
        """Removes the steps but those that ``keep`` returned as ``needed``, and all bucketed tables.

        What reads other steps must have been written by then.
        """
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.drop(*(df for _, df in self.kept if not any(df is other for other in needed)))
        self.tables = []

    def drop(self, *done: DataFrame) -> None:
        """Removes the files of steps that ``keep`` returned; what reads them must have been written by then."""
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        gone = [path for path, df in self.kept if any(df is other for other in done)]
        for path in gone:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self.kept = [(path, df) for path, df in self.kept if path not in gone]


def chunks(
    batches: Iterator[pa.RecordBatch], most: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of a task in pieces of about ``most`` bytes, so that memory is bounded.

    At the end Arrow gives back what it holds in reserve: a worker outlives its task, and
    the next one may come long after, in a step that needs the memory elsewhere.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= most:
                yield _merged(held)
                held, size = [], 0
    if held:
        yield _merged(held)
    del held
    pa.default_memory_pool().release_unused()


def _merged(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def complete_runs(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by ``keys`` (long), regrouped so that no run of equal keys is cut.

    Yields rows and the starts of the runs in them, with the number of rows at the end.
    """
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if rest is None else _merged([rest, batch])
        starts = _starts(rows, keys)
        last = int(starts[-2])
        rest = rows.slice(last)
        if last:
            yield rows.slice(0, last), starts[:-1]
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _starts(rows: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    changed = np.zeros(rows.num_rows, dtype=bool)
    changed[0] = True
    for key in keys:
        values = rows.column(key).to_numpy(zero_copy_only=False)
        changed[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed), rows.num_rows)


def words_of(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts and where each text's begin.

    ``lower`` turns A-Z into a-z and leaves other letters alone.
    """
    # a copy, as splitting goes wrong on slices of larger arrays
    text = text.take(pa.array(np.arange(len(text)))).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten()
    filled = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(filled)])
    return flat.filter(pa.array(filled)), before[offsets - offsets[0]]


def binaries(parts: Sequence[np.ndarray]) -> pa.Array:
    return pa.array([part.tobytes() for part in parts], pa.binary())


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each text, 0 for texts that have none."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]
