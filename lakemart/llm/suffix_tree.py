"""Language-model scores by a probabilistic suffix tree (operator 2).

Method. Tokens are the words of a text, A-Z lowered, and one end. The root of the
tree is the unigram distribution of the training tokens, with one added to each count. A
context of one to three words that occurs ``least_count`` times in training text is a
state if its next tokens diverge from those of its suffix: the sum over next tokens of
count times log(share after the context / share after its suffix), in nats, must reach
``least_gain`` plus one for each different next token (added up in whole 256ths).
Distributions are smoothed by absolute discounting towards the suffix, so all counts of a
context are kept. A token is scored in the longest suffix of what precedes it that is a
state. The least count is absolute: more text gives more contexts, states and counts.

How it runs. Texts are coded once, in parts of about ``PART_BYTES``, one row a part; that table
is bucketed by part, as are the answers below, so that no later step moves them. What the tree holds is spread by key: a
part asks for the distinct keys it has (words, contexts with a next token, contexts), as
sorted blocks of hashes, a block for each range of keys, together with what it adds to
them. A task a range adds up what all parts have, and answers each part block by block.
Keys are hashes of a whole context and its next token, so a frequent context is spread over
all ranges. Answers go on to the next round:

1. words; the parts are written again with the counts and with numbers for the words, which
   take a third of the room of their hashes;
2. words with their next token;
3. contexts of two words, which occur ``least_count`` times, with their next token; and for contexts
   of one word the number of next tokens and the divergence, each pair's share of it from the first
   part that has the pair;
4. the same for contexts of three words with their next token, and for contexts of two;
5. the same for contexts of three words.

What only one part has, held-out texts included, is told so. All that holds it is then only
there too, so its counts are the part's own and it isn't asked for again. The sums of a round
are written before they are dealt out, so that what the parts sent is gone by then.

Hashes of words have 64 bits; those of contexts have ``SPARE_BITS`` more than the number of tokens,
so about one context in a million meets another, which then have one count, at any size. Two
words are told apart by their numbers, if these take no more bits than that.
Then each part scores its texts. Nothing of this passes through the driver but two totals.

Defined cases. Null text is empty and scored as a lone end. Rows that repeat an id
count and are scored each; a null id counts as empty text. Without training rows all scores are 0.
Extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, chunks, id_and_text, remainder, words_of

FOLDS, HELD_FOLD = 7, 2
LEAST_COUNT = 4
LEAST_GAIN = 5.0
DISCOUNT = 0.75
PART_BYTES = 4 << 20
#: Tokens of the corpus for each range of keys.
RANGE_TOKENS = 1 << 22
#: Files of a bucketed table; beyond that a task reads several parts, one after another.
MOST_BUCKETS = 20_000
#: Divergences are added up as whole numbers of this unit, so that sums don't depend on their order.
UNIT = 256

SPARE_BITS = 20
#: Rounds after that of the words.
ROUNDS = 4
_END_KEY = np.uint64(0x5BD1E995A7F3C1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

WORDS, PAIRS, TRIPLES, QUADS, SHORT_CONTEXTS, PAIR_CONTEXTS, TRIPLE_CONTEXTS = range(7)


def key_of_word(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def extended(context: np.ndarray, token: np.ndarray, bits: int) -> np.ndarray:
    """The keys of contexts with a token after them, which are also keys of longer contexts."""
    x = context * _A + token
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - bits)


def paired(context: np.ndarray, token: np.ndarray, bits: int) -> np.ndarray:
    """Keys of two numbers of ``bits`` bits each: spread evenly over twice the bits, and each pair has its own."""
    half, mask = np.uint64(bits), np.uint64((1 << 2 * bits) - 1)
    x = context << half | token
    for factor in (_A, _B, _C):
        x = x * factor & mask
        x ^= x >> half
    return x


_TAIL = struct.Struct("<IIB")  # numbers, bytes of the highest plane, planes


# --- blocks of numbers --------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, as planes of bytes, without planes of zeros above.

    The highest plane is compressed by itself: below it, those of a short block are mostly noise.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    codec = pa.Codec("zstd", 1)
    high = codec.compress(planes[-1].tobytes(), asbytes=True)
    low = codec.compress(planes[:-1].tobytes(), asbytes=True) if width > 1 else b""
    return low + high + _TAIL.pack(len(values), len(high), width)


def unpacked(block: bytes) -> np.ndarray:
    size, high, width = _TAIL.unpack_from(block, len(block) - _TAIL.size)
    codec, held = pa.Codec("zstd"), memoryview(block)[: -_TAIL.size]
    cut = len(held) - high
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, width - 1] = np.frombuffer(codec.decompress(held[cut:], size, asbytes=True), np.uint8)
    if width > 1:
        low = codec.decompress(held[:cut], size * (width - 1), asbytes=True)
        out[:, : width - 1] = np.frombuffer(low, np.uint8).reshape(width - 1, -1).T
    return out.view(np.uint64).ravel()


def _signed(values: np.ndarray) -> np.ndarray:
    """Numbers of both signs as numbers from 0 on; small ones stay small."""
    return ((values << 1) ^ (values >> 63)).astype(np.uint64)


def _unsigned(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the place among them of each key."""
    order = np.argsort(keys)
    held = keys[order]
    fresh = np.ones(len(held), dtype=bool)
    fresh[1:] = held[1:] != held[:-1]
    place = np.empty(len(held), dtype=np.int64)
    place[order] = np.cumsum(fresh) - 1
    return held[fresh], place


# --- parts of the text ----------------------------------------------------------

_PART = "part long, doc_ids array<long>, held binary, words binary, tokens binary, keys binary, size long, training long"


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each part: its texts as numbers of tokens, frequent ones first, and their keys."""
    task = TaskContext.get().partitionId()
    for k, batch in enumerate(chunks(batches, PART_BYTES)):
        found, starts = words_of(batch.column("text"))
        coded = found.dictionary_encode()
        n = np.diff(starts)
        ends = starts[1:] + np.arange(len(n))
        tokens = np.zeros(len(found) + len(n), dtype=np.int64)
        inner = np.ones(len(tokens), dtype=bool)
        inner[ends] = False
        tokens[inner] = coded.indices.to_numpy(zero_copy_only=False) + 1
        keys = [int(_END_KEY), *map(key_of_word, coded.dictionary.to_pylist())]
        keys = np.array(keys, dtype=np.uint64)
        # words as frequent are in order of keys, which take less room then
        order = np.lexsort((keys, -np.bincount(tokens, minlength=len(keys))))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        held = batch.column("held_out").to_numpy(zero_copy_only=False)
        yield pa.record_batch(
            {
                "part": pa.array([task << 24 | k], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays(
                    pa.array([0, len(n)], pa.int32()), batch.column("doc_id").cast(pa.int64())
                ),
                "held": pa.array([packed(held)], pa.binary()),
                "words": pa.array([packed(n)], pa.binary()),
                "tokens": pa.array([packed(place[tokens])], pa.binary()),
                "keys": pa.array([packed(keys[order])], pa.binary()),
                "size": pa.array([len(tokens)], pa.int64()),
                "training": pa.array([int((n + 1)[~held].sum())], pa.int64()),
            }
        )


@dataclass
class Settings:
    """Limits and totals that all tasks share."""

    least_count: int
    least_gain: float
    discount: float
    range_bits: int
    key_bits: int
    tokens: int
    distinct: int = 0
    word_bits: int = 64

    @property
    def pair_bits(self) -> int:
        return min(2 * self.word_bits, self.key_bits)

    def bits(self, kind: int) -> int:
        return {WORDS: 64, PAIRS: self.pair_bits, SHORT_CONTEXTS: self.word_bits}.get(kind, self.key_bits)


def requests(settings: Settings, part: int, kind: int, keys: np.ndarray, *values: np.ndarray) -> pa.Table:
    """Blocks of sorted keys and of what a part adds to them, by range of keys."""
    shift = np.uint64(max(settings.bits(kind) - settings.range_bits, 0))
    of_range = (keys >> shift).astype(np.int64) if settings.range_bits else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.diff(of_range, prepend=-1))
    bounds = [*zip(at.tolist(), [*at[1:].tolist(), len(keys)])]
    # a block's first key counts from the first one of its range
    least = of_range.astype(np.uint64) << shift if settings.range_bits else np.zeros(len(keys), np.uint64)
    blocks = [packed(np.diff(keys[a:b], prepend=least[a])) for a, b in bounds]
    amounts = [[packed(v[a:b]) for a, b in bounds] for v in values]
    gains = amounts[1] if len(values) > 1 else [None] * len(bounds)
    arrays = [
        pa.array([kind] * len(bounds), pa.int32()),
        pa.array(of_range[at]),
        pa.array([part] * len(bounds), pa.int64()),
        *(pa.array(x, pa.binary()) for x in (blocks, amounts[0], gains)),
    ]
    return pa.table(arrays, names=["kind", "range", "part", "keys", "counts", "gains"])


class Part:
    """A part of the text, its words numbered and counted, with what is known of contexts so far."""

    def __init__(self, row: dict, settings: Settings):
        self.doc_ids, self.settings = row["doc_ids"], settings
        self.requests = partial(requests, settings, row["part"])
        self.n_tokens = unpacked(row["words"]).astype(np.int64) + 1
        self.held = unpacked(row["held"]).astype(bool)[: len(self.n_tokens)]
        self.tokens = unpacked(row["tokens"]).astype(np.int64)
        self.keys, self.count = unpacked(row["keys"]), unpacked(row["counts"]).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.n_tokens)])
        self.counted = np.repeat(~self.held, self.n_tokens)
        # tokens that come after a word of their text, and contexts of one word with a next token
        inner = np.ones(len(self.tokens), dtype=bool)
        inner[self.begins[:-1]] = False
        self.inner, self.after = inner, np.flatnonzero(inner)
        self.token_keys = self.keys[self.tokens]
        context, token = self.token_keys[self.after - 1], self.token_keys[self.after]
        self.spare = np.uint64(settings.key_bits - settings.pair_bits)
        if settings.pair_bits == 2 * settings.word_bits:
            keys = paired(context, token, settings.word_bits) << self.spare
        else:
            keys = extended(context, token, settings.key_bits)
        self.pair_keys, self.pair_place = distinct(keys)
        self.pairs_here = self._summed(self.pair_place, self.counted[self.after], len(self.pair_keys))

    def _summed(self, place: np.ndarray, amounts: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(place, weights=amounts, minlength=size).astype(np.int64)

    def first_requests(self) -> pa.Table:
        return self.requests(PAIRS, self.pair_keys >> self.spare, self.pairs_here)

    def learn_pairs(self, answers: Answers) -> None:
        """Takes counts of pairs; finds the contexts of two words that are frequent enough."""
        least = self.settings.least_count
        of_pair, self.pair_first, lone = answers.sums(PAIRS, self.pairs_here)
        self.of_pair = of_pair
        self.pairs = np.zeros(len(self.tokens), dtype=np.int64)
        self.pairs[self.after] = of_pair[self.pair_place]
        keys = np.zeros(len(self.tokens), dtype=np.uint64)
        keys[self.after] = self.pair_keys[self.pair_place]
        lone_pairs = np.zeros(len(self.tokens), dtype=bool)
        lone_pairs[self.after] = lone[self.pair_place]
        self.triples = self.longer(self.pairs, keys, lone_pairs)
        # contexts of one word
        worded = np.ones(len(self.keys), dtype=bool)
        worded[self.tokens[self.begins[1:] - 1]] = False
        self.short = np.flatnonzero((self.count >= least) & worded)
        self.short = self.short[np.argsort(self.keys[self.short])]

    def second_requests(self) -> pa.Table:
        # each pair adds to its context once, from the first part that has it
        at = np.zeros(len(self.pair_keys), dtype=np.int64)
        at[self.pair_place] = self.after
        context, n = self.tokens[at - 1], self.of_pair
        some = self.pair_first & (n > 0) & (self.count[context] >= self.settings.least_count)
        context, at, n = context[some], at[some], n[some]
        gain = _gain(n, self.count[context], self.count[self.tokens[at]], self.settings.tokens)
        kinds = np.bincount(context, minlength=len(self.keys))[self.short]
        gains = _added(context, gain, len(self.keys))[self.short]
        return pa.concat_tables(
            [
                self.triples.requests(TRIPLES),
                self.requests(SHORT_CONTEXTS, self.keys[self.short], kinds, _signed(gains)),
            ]
        )

    def longer(self, n: np.ndarray, keys: np.ndarray, lone: np.ndarray) -> Longer:
        """The tokens after contexts that are counted ``n`` where these end, and frequent enough."""
        at = np.flatnonzero((n[:-1] >= self.settings.least_count) & self.inner[1:]) + 1
        found, place = distinct(extended(keys[at - 1], self.token_keys[at], self.settings.key_bits))
        here = self._summed(place, self.counted[at], len(found))
        # what begins or ends with something that only this part has is only here as well
        asked = np.ones(len(found), dtype=bool)
        asked[place[lone[at - 1] | lone[at]]] = False
        contexts, context_place = distinct(keys[at - 1])
        return Longer(self, at, found, place, here, asked, contexts, context_place)

    def learn_triples(self, answers: Answers) -> None:
        """Takes counts of triples, and the states of one word; finds frequent contexts of three words."""
        self.twos, keys, lone = self.triples.learn(answers, TRIPLES)
        self.quads = self.longer(self.twos, keys, lone)
        self.short_kinds = np.zeros(len(self.keys), dtype=np.int64)
        self.short_state = np.zeros(len(self.keys), dtype=bool)
        self.short_kinds[self.short], self.short_state[self.short] = answers.found(SHORT_CONTEXTS)

    def third_requests(self) -> pa.Table:
        of_words = self.count[self.tokens]
        return pa.concat_tables(
            [self.quads.requests(QUADS), self.triples.context_requests(PAIR_CONTEXTS, self.pairs, of_words)]
        )

    def learn_quads(self, answers: Answers) -> None:
        """Takes counts of quads, and the states of two words."""
        self.threes, _, _ = self.quads.learn(answers, QUADS)
        self.pair_kinds, self.pair_state = answers.found(PAIR_CONTEXTS)

    def fourth_requests(self) -> pa.Table:
        return self.quads.context_requests(TRIPLE_CONTEXTS, self.twos, self.pairs)

    def scores(self, answers: Answers) -> pa.Table:
        settings = self.settings
        kinds, states = answers.found(TRIPLE_CONTEXTS)
        log_total = np.log10(settings.tokens + settings.distinct + 1)
        base = np.log10(self.count + 1.0) - log_total
        p = 10 ** base[self.tokens]
        best = p.copy()

        def level(at: np.ndarray, n: np.ndarray, of_context: np.ndarray, kinds: np.ndarray, states: np.ndarray):
            own = np.maximum(n - settings.discount, 0) / of_context
            p[at] = own + settings.discount * kinds / of_context * p[at]
            best[at[states]] = p[at[states]]

        context = self.tokens[self.after - 1]
        some = self.count[context] >= settings.least_count
        at, context = self.after[some], context[some]
        level(at, self.pairs[at], self.count[context], self.short_kinds[context], self.short_state[context])
        for longer, n, of_contexts, kinds, states in (
            (self.triples, self.twos, self.pairs, self.pair_kinds, self.pair_state),
            (self.quads, self.threes, self.twos, kinds, states),
        ):
            at, place = longer.at, longer.context_place
            level(at, n[at], of_contexts[at - 1], kinds[place], states[place])
        starts = self.begins[:-1]
        return pa.table(
            {
                "doc_id": pa.array(self.doc_ids, pa.int64()),
                "held_out": pa.array(self.held),
                "n_tokens": pa.array(self.n_tokens),
                "n_known": pa.array(np.add.reduceat((self.count[self.tokens] > 0).astype(np.int64), starts)),
                "train_tokens": pa.array(np.full(len(starts), settings.tokens), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base[self.tokens], starts)),
                "score": pa.array(np.add.reduceat(np.log10(best), starts)),
            }
        )


@dataclass
class Longer:
    """Contexts of two or three words with their next tokens, by the places of these."""

    part: Part
    at: np.ndarray
    keys: np.ndarray
    place: np.ndarray
    here: np.ndarray
    asked: np.ndarray
    contexts: np.ndarray
    context_place: np.ndarray

    def requests(self, kind: int) -> pa.Table:
        return self.part.requests(kind, self.keys[self.asked], self.here[self.asked])

    def learn(self, answers: Answers, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes the counts; by token: its count, its key, and whether only this part has it."""
        self.n, self.first, lone = self.here.copy(), ~self.asked, ~self.asked
        found = answers.sums(kind, self.here[self.asked])
        self.n[self.asked], self.first[self.asked], lone[self.asked] = found
        out = [np.zeros(len(self.part.tokens), dtype=x.dtype) for x in (self.n, self.keys, lone)]
        for held, values in zip(out, (self.n, self.keys, lone)):
            held[self.at] = values[self.place]
        return tuple(out)

    def context_requests(self, kind: int, n: np.ndarray, n_suffix: np.ndarray) -> pa.Table:
        """Next tokens and divergences, given the counts of the contexts and of their suffixes where they end."""
        at = np.zeros(len(self.keys), dtype=np.int64)
        at[self.place] = np.arange(len(self.at))
        some = self.first & (self.n > 0)
        at = at[some]
        context, token = self.context_place[at], self.at[at]
        gain = _gain(self.n[some], n[token - 1], n[token], n_suffix[token - 1])
        kinds = np.bincount(context, minlength=len(self.contexts))
        return self.part.requests(kind, self.contexts, kinds, _signed(_added(context, gain, len(self.contexts))))


def _gain(n: np.ndarray, of_context, below: np.ndarray, of_suffix) -> np.ndarray:
    """What a next token adds to the divergence of a context from its suffix, in units."""
    ratio = np.log(n / of_context) - np.log(below / of_suffix)
    return np.rint(n * ratio * UNIT).astype(np.int64)


def _added(place: np.ndarray, amounts: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=np.int64)
    np.add.at(out, place, amounts)
    return out


# --- ranges of keys ---------------------------------------------------------------

_REQUESTS = "kind int, range long, part long, keys binary, counts binary, gains binary"
_ANSWERS = "kind int, range long, part long, totals binary, flags binary"
_NUMBERS = "range long, part long, counts binary, places binary, words long, different long"
_NUMBERED = "part long, doc_ids array<long>, held binary, words binary, tokens binary, keys binary, counts binary"


def _ask_words(settings: Settings) -> Callable:
    def ask(table: pa.Table) -> pa.Table:
        (row,) = table.to_pylist()
        n, keys = unpacked(row["words"]).astype(np.int64) + 1, unpacked(row["keys"])
        counted = np.repeat(unpacked(row["held"])[: len(n)] == 0, n)
        counts = np.bincount(unpacked(row["tokens"]).astype(np.int64)[counted], minlength=len(keys))
        order = np.argsort(keys)
        return requests(settings, row["part"], WORDS, keys[order], counts[order])

    return ask


def _add_words(block: pa.Table) -> pa.Table:
    """The counts of words over all parts, and their places among the words of the range."""
    keys = [np.cumsum(unpacked(x)) for x in block.column("keys").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
    counts = np.concatenate([unpacked(x) for x in block.column("counts").to_pylist()]).astype(np.int64)
    held, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = _added(place, counts, len(held))
    pairs = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
    rest = [0] * (len(pairs) - 1)
    return pa.table(
        {
            **{name: block.column(name) for name in ("range", "part")},
            "counts": pa.array([packed(totals[place[a:b]]) for a, b in pairs], pa.binary()),
            "places": pa.array([packed(np.diff(place[a:b], prepend=0)) for a, b in pairs], pa.binary()),
            "words": pa.array([len(held), *rest], pa.int64()),
            "different": pa.array([int((totals > 0).sum()), *rest], pa.int64()),
        }
    )


def _number(range_bits: int) -> Callable:
    def number(table: pa.Table) -> pa.Table:
        """A part with the numbers of its words instead of their keys, and their counts."""
        (row,) = table.to_pylist()
        order = np.argsort(unpacked(row["keys"]))
        found = sorted(row["numbers"], key=lambda x: x["range"])
        numbers, counts = np.zeros((2, len(order)), dtype=np.uint64)
        numbers[order] = np.concatenate(
            [np.cumsum(unpacked(x["places"])) << np.uint64(range_bits) | np.uint64(x["range"]) for x in found]
        )
        counts[order] = np.concatenate([unpacked(x["counts"]) for x in found])
        schema = table.select(["part", "doc_ids", "held", "words", "tokens"])
        return schema.append_column("keys", pa.array([packed(numbers)], pa.binary())).append_column(
            "counts", pa.array([packed(counts)], pa.binary())
        )

    return number


def _range(least_gain: float) -> Callable:
    def add_up(block: pa.Table) -> pa.Table:
        """The sums over all parts, for each block the parts sent.

        Of contexts a part gets the sum and whether they are states. Of all else it gets 0 if no
        other part has it, or else 1 and what the others have of it, and whether it is the first
        of them.
        """
        block = block.sort_by("part")
        kind = block.column("kind")[0].as_py()
        # all blocks are of one range, so keys may count from its first one
        keys = [np.cumsum(unpacked(x)) for x in block.column("keys").to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
        counts = np.concatenate([unpacked(x) for x in block.column("counts").to_pylist()]).astype(np.int64)
        held, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        totals = _added(place, counts, len(held))
        if kind in (SHORT_CONTEXTS, PAIR_CONTEXTS, TRIPLE_CONTEXTS):
            gains = np.concatenate([_unsigned(unpacked(x)) for x in block.column("gains").to_pylist()])
            flags = (_added(place, gains, len(held)) >= (least_gain + totals) * UNIT)[place]
            sums = totals[place]
        else:
            several = np.bincount(place, minlength=len(held)) > 1
            flags = np.zeros(len(place), dtype=bool)
            flags[first[several]] = True
            sums = np.where(several[place], totals[place] - counts + 1, 0)
        pairs = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        return pa.table(
            {
                **{name: block.column(name) for name in ("kind", "range", "part")},
                "totals": pa.array([packed(sums[a:b]) for a, b in pairs], pa.binary()),
                "flags": pa.array([packed(np.packbits(flags[a:b])) for a, b in pairs], pa.binary()),
            }
        )

    return add_up


class Answers:
    """What the ranges sent back to a part, in order of keys."""

    def __init__(self, rows: list[dict] | None):
        self.rows: dict[int, list[tuple]] = {}
        for row in sorted(rows or [], key=lambda row: (row["kind"], row["range"])):
            totals = unpacked(row["totals"]).astype(np.int64)
            self.rows.setdefault(row["kind"], []).append((totals, row["flags"]))

    def found(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers and flags of all keys asked for."""
        held = self.rows.get(kind, [])
        if not held:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        flags = [np.unpackbits(unpacked(flags).astype(np.uint8), count=len(totals)) for totals, flags in held]
        return np.concatenate([totals for totals, _ in held]), np.concatenate(flags).astype(bool)

    def sums(self, kind: int, here: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts over all parts, given the part's own; whether it is the first to have a key, and the only one."""
        others, first = self.found(kind)
        lone = others == 0
        return here + np.maximum(others - 1, 0), first | lone, lone


def _round(settings: Settings, number: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        (row,) = table.to_pylist()
        part = Part(row, settings)
        ask = (part.first_requests, part.second_requests, part.third_requests, part.fourth_requests)
        learn = (part.learn_pairs, part.learn_triples, part.learn_quads)
        for k, take in enumerate(learn[: number - 1], 1):
            take(Answers(row[f"answers{k}"]))
        return ask[number - 1]() if number <= ROUNDS else part.scores(Answers(row[f"answers{ROUNDS}"]))

    return run


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def suffix_tree_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_count: int = LEAST_COUNT,
    least_gain: float = LEAST_GAIN,
    discount: float = DISCOUNT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Learns from rows whose crc32(id as text) mod 7 is not 2.
    """
    steps = Steps(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    texts = texts.withColumn("held_out", remainder("doc_id", FOLDS) == HELD_FOLD)
    tasks = (texts.select(F.spark_partition_id().alias("task")).agg(F.max("task")).first()[0] or 0) + 1
    buckets = max(tasks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = min(buckets, MOST_BUCKETS)
    parts = steps.keep_by(texts.mapInArrow(_code, _PART), "part", buckets)
    total = parts.agg(F.sum("training").alias("training"), F.sum("size").alias("size")).first()
    training, size = total["training"] or 0, total["size"] or 0
    ranges = (size // RANGE_TOKENS).bit_length()
    key_bits = min(64, size.bit_length() + SPARE_BITS)
    settings = Settings(least_count, least_gain, discount, ranges, key_bits, training)

    def dealt(sums: DataFrame, name: str, *columns: str) -> DataFrame:
        """Answers by part. The sums are written first: the shuffle files of the requests go before these come."""
        sums = steps.keep(sums)
        held = F.collect_list(F.struct(*columns)).alias(name)
        answers = steps.keep_by(sums.groupBy("part").agg(held), "part", buckets)
        if name == "numbers":
            most, settings.distinct = sums.agg(F.max("words"), F.sum("different")).first()
            settings.word_bits = ranges + max((most or 0) - 1, 1).bit_length()
            settings.distinct = settings.distinct or 0
        steps.drop(sums)
        return answers

    asked = parts.groupBy("part").applyInArrow(_ask_words(settings), _REQUESTS)
    numbers = dealt(asked.groupBy("range").applyInArrow(_add_words, _NUMBERS), "numbers", "range", "counts", "places")
    numbered = parts.join(numbers.hint("merge"), "part").groupBy("part").applyInArrow(_number(ranges), _NUMBERED)
    coded, parts = parts, steps.keep_by(numbered, "part", buckets)
    steps.drop(coded, numbers)

    def run(number: int, schema: str) -> DataFrame:
        # a row for each part, with all answers so far
        return parts.groupBy("part").applyInArrow(_round(settings, number), schema)

    for number in range(1, ROUNDS + 1):
        sums = run(number, _REQUESTS).groupBy("kind", "range").applyInArrow(_range(least_gain), _ANSWERS)
        answers = dealt(sums, f"answers{number}", "kind", "range", "totals", "flags")
        # a part of which nothing was asked has no answers
        parts = parts.join(answers.hint("merge"), "part", "left")
    scored = steps.keep(run(ROUNDS + 1, _SCORES))
    steps.drop_all_but(scored)
    return scored
