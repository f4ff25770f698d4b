"""Token ids in binary files with Elias-Fano document boundaries (operator 8).

Format. A shard is two files. ``.ids`` holds the ids of its documents one after
another, in two bytes each if the vocabulary allows, else in four, little-endian.
``.idx`` holds a header and two Elias-Fano sequences: where each document begins
(and where the last one ends), and the document ids less the smallest one.

Elias-Fano. Of n rising numbers up to u, the low ``log2(u / n)`` bits are stored
as they are and the high parts as a bit string with one set bit per number, under
``2 + log2(u / n)`` bits each. To find number i, the position of every 256th set
bit is stored, relative to the one before it, and the bytes from there on are
counted; no table of 64-bit offsets exists on disk.

Shards cover ranges of document ids and lie in ascending order. A task writes
files under a name of its own, and only a committed row of the manifest makes
them part of the data set, so retries and lost executors leave no mixture.

Defined cases. Null text is empty; an empty text holds the end id alone. Null
ids come first. Rows that repeat an id lie side by side, ordered by text.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, chunks, id_and_text, import_on_executors
from lakemart.llm.ragged import PIECE_CHUNK
from lakemart.llm.tokens import Pieces, encoder, vocabulary_size

END_ID = 0
SAMPLE = 256
MAGIC = b"EFID"
_HEAD = struct.Struct("<4sHHQQq")  # magic, bytes per id, spare, documents, null ids, smallest id
_PART = struct.Struct("<QQBI")  # numbers, largest, low bits, bytes of the high part

_POPULATION = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)


class EliasFano:
    """Numbers that never fall, packed; ``select`` finds one, ``block`` those in a row."""

    def __init__(self, n: int, most: int, bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.most, self.bits, self.low, self.high = n, most, bits, low, high
        set_bits = np.flatnonzero(np.unpackbits(high, bitorder="little"))[::SAMPLE]
        self.samples = np.diff(set_bits, prepend=0).astype("<u4")

    @classmethod
    def of(cls, values: Sequence[int] | np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, most = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (most // n).bit_length() - 1) if n else 0
        shifts = np.arange(bits, dtype=np.uint64)
        low = (values[:, None] >> shifts & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        high[places] = 1
        return cls(
            n,
            most,
            bits,
            np.packbits(low.ravel(), bitorder="little"),
            np.packbits(high, bitorder="little"),
        )

    def _place(self, i: int) -> int:
        """The place of the set bit of number ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[: i // SAMPLE + 1].sum(dtype=np.int64))
        ahead, at = i % SAMPLE, place // 8
        byte = int(self.high[at]) >> (place % 8) << (place % 8)
        while ahead >= _POPULATION[byte]:
            ahead -= int(_POPULATION[byte])
            at += 1
            byte = int(self.high[at])
        for _ in range(ahead):
            byte &= byte - 1
        return 8 * at + (byte & -byte).bit_length() - 1

    def select(self, i: int) -> int:
        """Number ``i`` without unpacking the rest."""
        place, start = self._place(i), i * self.bits
        raw = self.low[start // 8 : (start + self.bits + 7) // 8].tobytes()
        low = int.from_bytes(raw, "little") >> start % 8 & (1 << self.bits) - 1
        return (place - i << self.bits) + low

    def block(self, i: int, j: int) -> np.ndarray:
        """Numbers ``i`` to ``j - 1``; only their bits are unpacked."""
        if i >= j:
            return np.zeros(0, dtype=np.uint64)
        first, last = self._place(i), self._place(j - 1)
        held = np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little")
        places = first + np.flatnonzero(held[first % 8 : last - first // 8 * 8 + 1])
        high = (places - np.arange(i, j)).astype(np.uint64) << np.uint64(self.bits)
        if not self.bits:
            return high
        at, to = i * self.bits, j * self.bits
        low = np.unpackbits(self.low[at // 8 : -(-to // 8)], bitorder="little")
        low = low[at % 8 : at % 8 + to - at].reshape(j - i, -1).astype(np.uint64)
        return high + (low << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def last_within(self, i: int, most: int) -> int:
        """The greatest ``j`` from ``i`` on whose number is at most ``most``; ``i`` if there is none."""
        low, high = i, self.n
        while high - low > 1:
            middle = (low + high) // 2
            if self.select(middle) <= most:
                low = middle
            else:
                high = middle
        return low

    def dump(self) -> bytes:
        head = _PART.pack(self.n, self.most, self.bits, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def load(cls, raw: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence stored at a place, and where it ends."""
        n, most, bits, length = _PART.unpack_from(raw, at)
        at += _PART.size
        lows, count = -(-n * bits // 8), -(-n // SAMPLE)
        out = cls.__new__(cls)
        out.n, out.most, out.bits = n, most, bits
        out.low = np.frombuffer(raw, np.uint8, lows, at)
        out.high = np.frombuffer(raw, np.uint8, length, at + lows)
        out.samples = np.frombuffer(raw, "<u4", count, at + lows + length)
        return out, at + lows + length + 4 * count


def dump_index(starts: np.ndarray, doc_ids: list[int | None], width: int) -> bytes:
    known = [i for i in doc_ids if i is not None]
    least = known[0] if known else 0
    shifted = np.array(known, dtype=np.int64).astype(np.uint64) - np.uint64(least % 2**64)
    head = _HEAD.pack(MAGIC, width, 0, len(doc_ids), len(doc_ids) - len(known), least)
    return head + EliasFano.of(starts).dump() + EliasFano.of(shifted).dump()


@dataclass
class Index:
    """The index of a shard; boundaries and document ids stay packed."""

    starts: EliasFano
    shifted: EliasFano
    documents: int
    nulls: int
    least: int
    width: int

    def doc_ids(self, i: int, j: int) -> pa.Array:
        """Ids of documents ``i`` to ``j - 1``; those without one come first."""
        nulls = max(0, min(j, self.nulls) - i)
        known = self.shifted.block(max(i - self.nulls, 0), max(j - self.nulls, 0))
        known = (known + np.uint64(self.least % 2**64)).astype(np.int64)
        return pa.concat_arrays([pa.nulls(nulls, pa.int64()), pa.array(known)])


def load_index(raw: bytes) -> Index:
    magic, width, _, documents, nulls, least = _HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not an index of token ids")
    starts, at = EliasFano.load(raw, _HEAD.size)
    shifted, _ = EliasFano.load(raw, at)
    return Index(starts, shifted, documents, nulls, least, width)


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


_MANIFEST = "shard int, path string, documents long, tokens long"


def _writer(folder: str, path: str, end_id: int, width: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(Pieces, path, f"<u{width}")
        end = np.array([end_id], dtype=f"<u{width}").tobytes()
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        files, place = _files(name)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        out = None
        for batch in chunks(batches, PIECE_CHUNK):
            if out is None:
                files.create_dir(place.rpartition("/")[0], recursive=True)
                out = files.open_output_stream(f"{place}.ids")
            doc_ids += batch.column("doc_id").to_pylist()
            ids, bounds = pieces.packed(batch.column("text"))
            for a, b in zip(bounds[:-1], bounds[1:]):
                lengths.append((b - a) // width + 1)
                out.write(ids[a:b])
                out.write(end)
        if out is None:
            return
        out.close()
        starts = np.concatenate([[0], np.cumsum(lengths)])
        with files.open_output_stream(f"{place}.idx") as index:
            index.write(dump_index(starts, doc_ids, width))
        yield pa.record_batch(
            {
                "shard": pa.array([shard], pa.int32()),
                "path": [name],
                "documents": [len(doc_ids)],
                "tokens": [int(starts[-1])],
            }
        )

    return write


def write_id_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """Writes the files under ``folder`` and returns the manifest; run it once and keep it.

    The manifest has shard, path, documents, tokens.
    """
    width = 2 if max(vocabulary_size(tokenizer_path) - 1, end_id) < 1 << 16 else 4
    # ids that repeat very often are spread by text
    order = ["doc_id", "_hash"]
    texts = id_and_text(docs, id_col, text_col).withColumn("_hash", F.xxhash64("text"))
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return ordered.select("doc_id", "text").mapInArrow(
        _writer(folder, tokenizer_path, end_id, width), _MANIFEST
    )


def _reader(most: int = 1 << 22) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, place = _files(row["path"])
                with files.open_input_file(f"{place}.idx") as held:
                    index = load_index(held.read())
                starts, width = index.starts, index.width
                with files.open_input_file(f"{place}.ids") as ids:
                    at = 0
                    while at < index.documents:
                        start = starts.select(at)
                        to = max(at + 1, starts.last_within(at, start + most))
                        bounds = starts.block(at, to + 1).astype(np.int64)
                        ids.seek(start * width)
                        raw = ids.read(int(bounds[-1] - start) * width)
                        packed = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                        cuts = 4 * (bounds - start)
                        crcs = [zlib.crc32(packed[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                        yield pa.record_batch(
                            {
                                "doc_id": index.doc_ids(at, to),
                                "start": pa.array(row["base"] + bounds[:-1]),
                                "n_tokens": pa.array(np.diff(bounds)),
                                "ids_crc32": pa.array(crcs, pa.int64()),
                            }
                        )
                        at = to

    return read


def read_id_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    The manifest has one row per shard, so it is small enough for the driver,
    which adds up where the shards begin.
    """
    import_on_executors(spark)
    base, rows = 0, []
    for row in manifest.orderBy("shard").collect():
        rows.append((row["shard"], row["path"], base))
        base += row["tokens"]
    shards = spark.createDataFrame(rows, "shard int, path string, base long")
    spread = shards.repartitionByRange(max(1, len(rows)), "shard")
    return spread.mapInArrow(_reader(), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(path: str, i: int) -> np.ndarray:
    """The ids of document ``i`` of a shard; reads no other document's."""
    files, place = _files(path)
    with files.open_input_file(f"{place}.idx") as held:
        index = load_index(held.read())
    start, end = index.starts.select(i), index.starts.select(i + 1)
    with files.open_input_file(f"{place}.ids") as ids:
        ids.seek(start * index.width)
        return np.frombuffer(ids.read((end - start) * index.width), f"<u{index.width}")


def id_files_round_trip(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes all documents to a new shared folder and reads them back."""
    steps = Steps(docs.sparkSession)
    written = write_id_files(docs, f"{steps.folder}/ids", tokenizer_path, id_col, text_col)
    return read_id_files(docs.sparkSession, steps.keep(written))
