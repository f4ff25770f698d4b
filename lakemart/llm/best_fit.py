"""Best-fit packing of documents into sequences (operator 7).

Method. Documents become pieces of at most ``capacity`` tokens. Only the number
of pieces of each length matters for a packing, so Spark counts lengths, at most
``capacity`` numbers however large the corpus, and the packing is found on these.
First the dominance reduction of Martello and Toth fixes sets that some best
packing holds: a piece alone if nothing fits beside it; with the largest that
fits, if it fills the sequence, or no two others fit, or it is no less than any
two that fit; with the two that no other two exceed one by one. What remains is
packed best-fit, longest first. The packing is stated in runs of equal sequences,
and a piece finds its place by its rank among the pieces of its length.

Ranks come from counts of lengths by task, so a length that a third of all
pieces share is never brought to one place.

Defined cases. Null text is empty; an empty text is one piece with the end id.
Rows that repeat an id are packed each on its own. Order of sequences and of
ranks carries no meaning.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, chunks, id_and_text
from lakemart.llm.ragged import PIECE_CHUNK
from lakemart.llm.tokens import Pieces, encoder

CAPACITY = 4096
END_ID = 1
#: Bytes of pieces that a worker keeps; little, as packing follows other stages in the same workers.
KEPT_BYTES = 64 << 20

#: Equal sequences: how many, and what each holds as (length, how often).
Run = tuple[int, list[tuple[int, int]]]


class Lengths:
    """Numbers of pieces by length, with the lengths that are left in order."""

    def __init__(self, counts: Mapping[int, int]):
        self.count = {length: n for length, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.order.remove(length)

    def largest(self, most: int, used: Counter) -> int | None:
        """The largest length up to ``most`` of which a piece beyond ``used`` is left."""
        at = bisect.bisect_right(self.order, most) - 1
        while at >= 0 and self.count[self.order[at]] <= used[self.order[at]]:
            at -= 1
        return self.order[at] if at >= 0 else None

    def smallest_sum(self, n: int, used: Counter) -> int | None:
        """Sum of the ``n`` shortest pieces beyond ``used``."""
        total = 0
        for length in self.order:
            take = min(n, self.count[length] - used[length])
            total, n = total + take * length, n - take
            if not n:
                return total
        return None


def dominant_set(left: Lengths, longest: int, capacity: int) -> list[int] | None:
    """A set with ``longest`` that dominates every other set with it, if one is known."""
    used, room = Counter([longest]), capacity - longest
    one = left.largest(room, used)
    if one is None:
        return [longest]
    if one == room:
        return [longest, one]
    two, three = left.smallest_sum(2, used), left.smallest_sum(3, used)
    if two is None or two > room:
        return [longest, one]
    if three is not None and three <= room:
        return None
    best, second = _pairs(left, room, used)
    if one >= best:
        return [longest, one]
    other = left.largest(room - one, used + Counter([one]))
    if other is not None and other >= second:
        # any two that fit have one at most ``one`` and the other at most ``other``
        return [longest, one, other]
    return None


def _pairs(left: Lengths, room: int, used: Counter) -> tuple[int, int]:
    """Of two pieces that fit together: the largest sum, and the largest of the smaller ones."""
    best = second = 0
    for small in left.order:
        if 2 * small > room:
            break
        if left.count[small] <= used[small]:
            continue
        large = left.largest(room - small, used + Counter([small]))
        if large is not None and large >= small:
            best, second = max(best, small + large), small
    return best, second


def fix_dominant(left: Lengths, capacity: int) -> list[Run]:
    """Takes dominating sets out of ``left`` until there is none; each set is a sequence."""
    runs: list[Run] = []
    changed = True
    while changed:
        changed = False
        for longest in sorted(left.order, reverse=True):
            while longest in left.count:
                found = dominant_set(left, longest, capacity)
                if found is None:
                    break
                need = Counter(found)
                # while all its members last, the set stays dominant in what remains
                times = min(left.count[length] // n for length, n in need.items())
                for length, n in need.items():
                    left.take(length, times * n)
                runs.append((times, sorted(need.items(), reverse=True)))
                changed = True
    return runs


def best_fit(counts: Mapping[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing: each piece goes where least room is left, else to a new sequence."""
    open_runs: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def add(room: int, run: Run) -> None:
        if room not in open_runs:
            bisect.insort(rooms, room)
        open_runs.setdefault(room, []).append(run)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                there, held = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room], rooms[at]
            else:
                room, there, held = capacity, -(-n // (capacity // length)), []
            # the sequence just used has least room, so it is used until it is full
            each = room // length
            full = min(there, n // each)
            if full:
                add(room - each * length, (full, [*held, (length, each)]))
                n -= full * each
                there -= full
            if there and n and n < each:
                add(room - n * length, (1, [*held, (length, n)]))
                n, there = 0, there - 1
            if there and held:
                add(room, (there, held))
    return [run for runs in open_runs.values() for run in runs]


def pack(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Sequences for so many pieces of each length (1 to ``capacity``)."""
    left = Lengths(counts)
    return fix_dominant(left, capacity) + best_fit(left.count, capacity)


def _places(runs: list[Run]) -> pd.DataFrame:
    """Where pieces of a length go, by rank: ``each`` at a time from ``sequence`` on."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for times, held in runs:
        offset = 0
        for length, each in held:
            rows.append((length, taken[length], sequence, offset, each))
            taken[length] += times * each
            offset += length * each
        sequence += times
    columns = ["length", "rank", "sequence", "offset", "each"]
    return pd.DataFrame(rows, columns=columns, dtype=np.int64).sort_values(["length", "rank"])


def _pieces(path: str, end_id: int, capacity: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, task = encoder(Pieces, path, "<u4", KEPT_BYTES), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in chunks(batches, PIECE_CHUNK):
            packed, bounds = pieces.packed(batch.column("text"))
            out = []
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1], bounds[1:]):
                ids = b"".join((packed[a:b], end))
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    out.append(
                        (doc_id, k, k * capacity, length, zlib.crc32(part), task, int(seen[length]))
                    )
                    seen[length] += 1
            yield pa.record_batch(
                [pa.array(column, kind) for column, kind in zip(zip(*out), _KINDS)], names=_NAMES
            )

    return cut


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
_KINDS = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"


def best_fit_packing(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids and ``end_id`` are cut only beyond ``capacity``; ``start``
    counts the document's ids before the piece, ``ids_crc32`` is over the ids as
    little-endian 32-bit numbers, ``offset`` is the place in the sequence.
    """
    steps = Steps(docs.sparkSession)
    pieces = steps.keep(
        id_and_text(docs, id_col, text_col).mapInArrow(
            _pieces(tokenizer_path, end_id, capacity), _PIECES
        )
    )
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = by_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    before = steps.keep(before)
    counts = {
        row["length"]: row["n"] for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    places = _places(pack(counts, capacity))
    shift = 44
    keys = (places["length"].to_numpy() << shift) | places["rank"].to_numpy()
    first, sequence = places["rank"].to_numpy(), places["sequence"].to_numpy()
    offset, each = places["offset"].to_numpy(), places["each"].to_numpy()

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted, ranks = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(keys, (wanted << shift) | ranks, "right") - 1
        step = ranks - first[at]
        return pd.DataFrame(
            {
                "sequence_id": sequence[at] + step // each[at],
                "offset": offset[at] + step % each[at] * wanted,
            }
        )

    # a row per task and length: it grows with the tasks, so it isn't broadcast
    earlier_tasks = before.drop("n").hint("merge")
    ranked = pieces.join(earlier_tasks, ["task", "length"]).withColumn(
        "at", place("length", F.col("before") + F.col("rank"))
    )
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"
    )
