"""Best-fit packing: the packing of lengths, and documents against the library."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakemart.llm.best_fit import Lengths, best_fit, best_fit_packing, dominant_set, fix_dominant, pack
from lakemart.llm.tokens import public_vocabulary

PATH = public_vocabulary("word_bpe_49k.json")


def fewest(items, capacity):
    """The least number of sequences, by search; for a few items."""
    items = tuple(sorted(items, reverse=True))
    best = [len(items)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[at]:
                k = rooms.index(room)
                place(at + 1, [*rooms[:k], room - items[at], *rooms[k + 1 :]])
        place(at + 1, [*rooms, capacity - items[at]])

    place(0, [])
    return best[0]


def holds(runs, counts, capacity):
    used = Counter()
    for times, held in runs:
        assert times > 0 and 0 < sum(length * n for length, n in held) <= capacity
        for length, n in held:
            used[length] += times * n
    assert used == Counter({length: n for length, n in counts.items() if n})
    return sum(times for times, _ in runs)


@pytest.mark.parametrize("seed", range(40))
def test_every_piece_is_placed_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 64, 4096])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 500)))
    n = holds(pack(counts, capacity), counts, capacity)
    total = sum(length * k for length, k in counts.items())
    assert -(-total // capacity) <= n <= max(1, 1.3 * total / capacity + 1) or not counts


@pytest.mark.parametrize("seed", range(60))
def test_fixed_sets_are_part_of_a_best_packing(seed):
    """Dominance: taking a set out lowers the least number of sequences by exactly one."""
    rng = random.Random(seed)
    capacity = rng.choice([10, 15, 20])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(2, 9))]
    for longest in sorted(set(items), reverse=True):
        found = dominant_set(Lengths(Counter(items)), longest, capacity)
        if found:
            rest = list((Counter(items) - Counter(found)).elements())
            assert fewest(rest, capacity) + 1 == fewest(items, capacity)


@pytest.mark.parametrize("seed", range(30))
def test_batches_of_fixed_sets_keep_the_best(seed):
    rng = random.Random(100 + seed)
    capacity = 12
    items = Counter(rng.choice([rng.randint(1, 12), 5, 7, 4]) for _ in range(9))
    left = Lengths(items)
    fixed = sum(times for times, _ in fix_dominant(left, capacity))
    assert fixed + fewest(Counter(left.count).elements(), capacity) == fewest(items.elements(), capacity)


def test_best_fit_is_the_step_by_step_one():
    rng = random.Random(5)
    for _ in range(50):
        capacity = rng.choice([10, 33])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 60)))
        rooms = []
        for item in sorted(counts.elements(), reverse=True):
            fitting = [r for r in rooms if r >= item]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - item)
            else:
                rooms.append(capacity - item)
        assert holds(best_fit(counts, capacity), counts, capacity) == len(rooms)


def check(docs, capacity=4096):
    library = Tokenizer.from_file(PATH)
    rows = [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]
    expected = Counter()
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            expected[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    found = best_fit_packing(docs, PATH, capacity=capacity).collect()
    assert Counter(tuple(row)[:5] for row in found) == expected
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(row.length for row in found) // capacity)


def test_given_documents(tiny_docs):
    used, least = check(tiny_docs[0])
    assert used <= least + 1


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_small_sequences_and_a_length_that_most_share(make_docs):
    rows = [(i, "same words here") for i in range(300)] + [(1000 + i, "word " * i) for i in range(40)]
    check(make_docs(*rows), capacity=16)


def test_special_strings_have_the_ids_of_a_plain_call(make_docs):
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|startoftext|>b <|endof text|>", "<|endoftext|><|endoftext|>\n"]
    check(make_docs(*enumerate(texts)))


def test_no_documents(no_docs):
    assert best_fit_packing(no_docs, PATH).collect() == []


def test_lengths_of_two_items():
    for a, b in combinations_with_replacement(range(1, 11), 2):
        counts = Counter([a, b])
        assert holds(pack(counts, 10), counts, 10) == (1 if a + b <= 10 else 2)
