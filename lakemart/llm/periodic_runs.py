"""Periodic runs of words by multi-scale minimizers (operator 13).

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` words long, that no neighbouring word extends keeping period q.

Method. Words of a chunk of texts are numbers in one array, with a number of its own after
each text. Periods below ``SHORT`` are found by comparing the array with itself
at each lag. For each scale above, with ``span`` doubling from ``SHORT``, periods from
``span`` up to twice that are found by minimizers: the least hash of ``span // 2`` words in a
row, the leftmost of equal ones, in each window of ``span`` words. The first window of a run
lies in its first period and comes again one period later, so its minimizer does too. Pairs
of equal minimizers at such distances are seeds. A seed is extended both ways by bisection
on prefix hashes; an extension of a period or more is a run, after it is compared word
by word (where hashes deceive, the lag is scanned instead).

Equal minimizers at most ``span / 4`` apart lie in a run of a short period and form
one cluster, however many they are. Within it no seed is needed: what has two
periods and the length of both has their greatest common divisor as a period. Between two
clusters each lag gets one seed. So seeds grow in proportion to the words, also in
texts that repeat one word. Of stretches with equal ends the one with the smallest
period is the run; the others have multiples of it.

Defined cases. Null, empty and blank texts have no words and no runs. Rows that repeat an
id are searched each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakemart.llm.common import chunks, id_and_text, words_of
from lakemart.llm.ragged import gather

#: Periods below this are found by direct scans of each lag.
SHORT = 16
LEAST_WORDS = 12

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(values: np.ndarray) -> np.ndarray:
    for _ in range(2):
        values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(32))


class _Prefixes:
    """Hashes of stretches of an array: sums of hashed words times powers, modulo 2**64."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.power = np.ones(n + 1, dtype=np.uint64)
        self.power[1:] = np.cumprod(np.full(n, _BASE))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        self.sums[1:] = np.cumsum(_mixed(words.astype(np.uint64)) * self.power[:n])

    def stretches(self, size: int) -> np.ndarray:
        """A hash for each stretch of ``size`` words, equal for equal words."""
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.power[n:0:-1])

    def _equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        lag = self.power[j - i]
        return (self.sums[i + size] - self.sums[i]) * lag == self.sums[j + size] - self.sums[j]

    def _most(self, low: np.ndarray, high: np.ndarray, holds: Callable) -> np.ndarray:
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``j`` on; ``i < j``."""
        most = len(self.sums) - 1 - j
        return self._most(np.zeros_like(i), most, lambda size: self._equal(i, j, size))

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` equal those before ``j``."""
        return self._most(np.zeros_like(i), i.copy(), lambda size: self._equal(i - size, j - size, size))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost least hash of each window of ``width`` hashes."""
    bits = np.uint64((1 << len(hashes).bit_length()) - 1)
    ranked = (hashes & ~bits) | np.arange(len(hashes), dtype=np.uint64)
    places = (_sliding_least(ranked, width) & bits).astype(np.int64)
    return places[np.flatnonzero(np.diff(places, prepend=-1))]


def _spread(first: np.ndarray, count: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row ``count`` numbers from ``first`` by ``step``, and the rows they are of."""
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return first[row] + nth * step[row], row


def _seeds(places: np.ndarray, keys: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags at which equal minimizers may be a period of this scale apart."""
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    near = (keys[1:] == keys[:-1]) & (np.diff(places) < 2 * span)
    held = np.append(near, False) | np.append(False, near)
    places, keys = places[held], keys[held]
    if not len(places):
        return places, places
    fresh = np.append(True, keys[1:] != keys[:-1])
    gaps = np.where(fresh, 0, np.diff(places, prepend=0))
    close = ~fresh & (gaps <= span // 4)
    # the clusters' steps are multiples of the short period, which equal minimizers share
    group = np.cumsum(fresh) - 1
    step = np.gcd.reduceat(np.where(close, gaps, 0), np.flatnonzero(fresh))[group]
    start = np.flatnonzero(~close)
    first, last = places[start], places[np.append(start[1:], len(places)) - 1]
    group, step = group[start], np.maximum(step[start], 1)
    found = []
    a = np.arange(len(start))
    for ahead in range(1, len(start)):
        a = a[: max(0, int(np.searchsorted(a, len(start) - ahead)))]
        b = a + ahead
        a, b = (x[(group[a] == group[b]) & (first[b] - last[a] < 2 * span)] for x in (a, b))
        if not len(a):
            break
        least, most = first[b] - last[a], last[b] - first[a]
        skipped = np.maximum(0, -(-(span - least) // step[a]))
        least = least + skipped * step[a]
        count = np.maximum(0, (np.minimum(most, 2 * span - 1) - least) // step[a] + 1)
        lag, row = _spread(least, count, step[a])
        found.append((np.minimum(last[a][row], last[b][row] - lag), lag))
    if not found:
        return places[:0], places[:0]
    return tuple(np.concatenate(x) for x in zip(*found))


@dataclass
class Runs:
    """Runs in order of text, start, period; starts count from the text's first word."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _same(words: np.ndarray, begin: int, end: int, lag: int) -> bool:
    return bool((words[begin : end - lag] == words[begin + lag : end]).all())


def _stretches_at(words: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of all longest stretches with a period, one equal word at least."""
    equal = np.flatnonzero(words[lag:] == words[:-lag])
    cut = np.flatnonzero(np.diff(equal) != 1)
    begins, ends = equal[np.append(0, cut + 1)[: len(equal)]], equal[np.append(cut, -1)[: len(equal)]]
    return begins, ends + 1 + lag


def _long_periods(words: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Begins, ends and periods from ``span`` up to twice that; some come twice."""
    size = span // 2
    prefixes = _Prefixes(words)
    hashes = prefixes.stretches(size)
    places = _minimizers(hashes, span - size + 1)
    at, lag = _seeds(places, hashes[places], span)
    if not len(at):
        return
    ahead, back = prefixes.after(at, at + lag), prefixes.before(at, at + lag)
    long = ahead + back >= lag
    found = np.stack([at - back, at + lag + ahead, lag])[:, long]
    found = np.unique(found, axis=1)
    good = np.array([_same(words, *run) for run in found.T.tolist()], dtype=bool)
    yield tuple(found[:, good])
    for lag in np.unique(found[2, ~good]).tolist():
        begins, ends = _stretches_at(words, lag)
        long = ends - begins >= 2 * lag
        yield begins[long], ends[long], np.full(int(long.sum()), lag)


def find_runs(words: np.ndarray, starts: np.ndarray, least: int = LEAST_WORDS) -> Runs:
    """All runs of texts whose words are numbers from 0 on; ``starts`` has their ends too."""
    n = np.diff(starts)
    texts = len(n)
    # each text is followed by a number of its own
    array = np.empty(len(words) + texts, dtype=np.int64)
    after = np.zeros(len(array), dtype=bool)
    after[starts[1:] + np.arange(texts)] = True
    array[~after], array[after] = words, -1 - np.arange(texts)
    found = []
    for lag in range(1, min(SHORT, len(array))):
        begins, ends = _stretches_at(array, lag)
        long = ends - begins >= max(least, 2 * lag)
        found.append((begins[long], ends[long], np.full(int(long.sum()), lag)))
    span = SHORT
    while texts and 2 * span <= n.max():
        place = np.flatnonzero(np.repeat(n >= 2 * span, n + 1))
        for begins, ends, lags in _long_periods(array[place], span):
            enough = ends - begins >= least
            found.append((place[begins[enough]], place[ends[enough] - 1] + 1, lags[enough]))
        span *= 2
    if not found:
        return Runs(*(np.zeros(0, dtype=np.int64) for _ in range(4)))
    begin, end, period = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    order = np.lexsort([period, end, begin])
    begin, end, period = begin[order], end[order], period[order]
    first = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))[: len(begin)]
    begin, end, period = begin[first], end[first], period[first]
    order = np.lexsort([period, begin])
    begin, end, period = begin[order], end[order], period[order]
    text = np.searchsorted(starts[1:] + np.arange(texts), begin)
    return Runs(text, begin - text - starts[text], end - begin, period)


def repeated_tail(ids: list[int | None], starts: np.ndarray) -> np.ndarray:
    """Places of the words that stand at each place once some texts have a tail that repeats.

    With h the crc32 of the id as text and g = h // 10, a text with h % 10 = 0 and n > 0
    words has, from word a = g % n on, its words a to a + p - 1 over and over, where
    p = 1 + (n - a) // (3 + g % 8). A null id counts as empty text.
    """
    place = np.arange(starts[-1])
    for k, doc_id in enumerate(ids):
        h, start, end = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id), int(starts[k]), int(starts[k + 1])
        n, g = end - start, h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            place[start + a : end] = start + a + np.arange(n - a) % p
    return place


Order = Callable[[list, np.ndarray], np.ndarray]


def _texts(least: int, order: Order | None, columns: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found, starts = words_of(batch.column("text"), lower=False)
            coded = found.dictionary_encode()
            words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            if order is not None:
                words = words[order(batch.column("doc_id").to_pylist(), starts)]
            runs = find_runs(words, starts, least)
            yield pa.record_batch(columns(batch.column("doc_id"), coded.dictionary, words, starts, runs))

    return run


def _rows(ids: pa.Array, held: pa.Array, words: np.ndarray, starts: np.ndarray, runs: Runs) -> dict:
    columns = {"start": runs.start, "length": runs.length, "period": runs.period}
    return {"doc_id": ids.take(pa.array(runs.text))} | {k: pa.array(v, pa.int64()) for k, v in columns.items()}


def _collapsed(held: pa.Array, words: np.ndarray, starts: np.ndarray, runs: Runs) -> list[memoryview]:
    """Each text's words, joined by a space, without those after the first period of a run."""
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    begin = starts[runs.text] + runs.start
    np.add.at(steps, begin + runs.period, 1)
    np.add.at(steps, begin + runs.length, -1)
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    spaced = pa.array([word.encode() + b" " for word in held.to_pylist()], pa.large_binary())
    data, offsets = gather(spaced, words[kept])
    bounds = offsets[np.searchsorted(kept, starts)].tolist()
    view = memoryview(data)
    return [view[a : max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:])]


def _texts_only(ids: pa.Array, held: pa.Array, words: np.ndarray, starts: np.ndarray, runs: Runs) -> dict:
    texts = [str(x, "utf-8") for x in _collapsed(held, words, starts, runs)]
    return {"doc_id": ids, "text": pa.array(texts, pa.string())}


def _digests(ids: pa.Array, held: pa.Array, words: np.ndarray, starts: np.ndarray, runs: Runs) -> dict:
    texts = len(starts) - 1
    count = np.bincount(runs.text, minlength=texts)
    # the longest run of each text, then the earliest, then the smallest period
    order = np.lexsort([runs.period, runs.start, -runs.length, runs.text])
    some = np.flatnonzero(count)
    best = np.full(texts, -1)
    best[some] = order[np.concatenate([[0], np.cumsum(count)[:-1]])[some]]
    take = pa.array(best, mask=best < 0)
    columns = {
        "start": runs.start, "length": runs.length, "period": runs.period,
        "exponent_milli": 1000 * runs.length // np.maximum(runs.period, 1),
    }
    bounds = np.concatenate([[0], np.cumsum(count)])
    lines = [b"%d,%d,%d\n" % run for run in zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist())]
    listed = [hashlib.sha256(b"".join(lines[a:b])).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
    collapsed = [hashlib.sha256(x).hexdigest() for x in _collapsed(held, words, starts, runs)]
    return {
        "doc_id": ids,
        "n_runs": pa.array(count, pa.int64()),
        **{name: pa.array(values, pa.int64()).take(take) for name, values in columns.items()},
        "runs_sha256": pa.array(listed, pa.string()),
        "collapsed_sha256": pa.array(collapsed, pa.string()),
    }


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    order: Order | None = None,
) -> DataFrame:
    """One row per run: doc_id, start (word number), length, period in words.

    ``order`` may put other words of the same chunk at each place before the search.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _texts(least, order, _rows), "doc_id long, start long, length long, period long"
    )


def collapse_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    order: Order | None = None,
) -> DataFrame:
    """doc_id and text: the words joined by a space, of each run the first period only."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _texts(least, order, _texts_only), "doc_id long, text string"
    )


def run_digests(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    order: Order | None = None,
) -> DataFrame:
    """One row per document: the number of runs, the longest one, digests of all and of the rest.

    Columns: doc_id, n_runs; start, length, period, exponent_milli of the longest run
    (then the earliest, then that of the smallest period; null without runs); runs_sha256 over
    ``start,length,period`` and a line feed of each run by start, then period;
    collapsed_sha256 over the collapsed text.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _texts(least, order, _digests),
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string",
    )
