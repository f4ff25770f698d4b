"""Whole columns of text as pieces: cut at byte positions, coded once, gathered by offsets.

Texts of a chunk lie one after another in one buffer. A rule marks the bytes at which
pieces begin; Arrow codes the pieces by their distinct values, only those are looked
up, and what was found for them is taken by number. So Python handles each
distinct piece of a chunk once, whatever the number of times it occurs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; larger chunks repeat more of their pieces.
PIECE_CHUNK = 16 << 20
#: Bytes that a worker keeps in values of pieces, with what Python adds to each.
KEPT_BYTES = 160 << 20
_ENTRY_BYTES = 180

#: Kinds of bytes: ASCII white space, ASCII letters, marks that end a word, first bytes of wide spaces.
_SPACE, _LETTER, _MARK, _WIDE = 1, 2, 4, 8
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[list(b".,;:!?")] = _MARK
#: The other characters of Unicode's property White_Space (fixed values).
WIDE_SPACES = [
    chr(c).encode()
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]
_KIND[sorted({c[0] for c in WIDE_SPACES})] = _WIDE
_WIDE_CODES = {n: [int.from_bytes(c, "big") for c in WIDE_SPACES if len(c) == n] for n in (2, 3)}


def buffer_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end."""
    text = text.cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spaced(data: np.ndarray) -> np.ndarray:
    """Pieces of white space, if any, and what follows up to the next white space.

    A mark after an ASCII letter begins a piece too. Byte-level BPE and BPE on lone
    words both have a border at each of these places.
    """
    kind = _KIND[data]
    space = kind == _SPACE
    wide = np.flatnonzero(kind == _WIDE)
    if len(wide):
        padded = np.append(data, np.zeros(2, np.uint8)).astype(np.uint32)
        two = padded[wide] << 8 | padded[wide + 1]
        for n, found in ((2, two), (3, two << 8 | padded[wide + 2])):
            at = wide[np.isin(found, _WIDE_CODES[n])]
            for k in range(n):
                space[at + k] = True
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[1:] |= (kind[1:] | kind[:-1]) == _LETTER | _MARK
    return begins


def space_runs(data: np.ndarray) -> np.ndarray:
    """Pieces of spaces (0x20), if any, and what follows up to the next space."""
    space = data == 32
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    return begins


@dataclass
class Coded:
    """Distinct pieces, the number of each piece, and where the pieces of each text begin."""

    distinct: list[bytes]
    index: pa.Array
    starts: np.ndarray


def code(
    text: pa.Array, rule: Callable[[np.ndarray], np.ndarray], whole: Sequence[str] = ()
) -> Coded:
    """Cuts texts into pieces by a rule; strings of ``whole`` are pieces of their own."""
    data, offsets = buffer_of(text)
    begins = rule(data)
    if whole and len(data):
        for at, end in _found(data, offsets, whole):
            begins[at:end] = False
            begins[at] = True
            if end < len(data):
                begins[end] = True
    filled = offsets[:-1][np.diff(offsets) > 0]
    begins[filled] = True
    at = np.flatnonzero(begins)
    starts = np.searchsorted(at, offsets)
    bounds = np.append(at, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = pieces.dictionary_encode()
    return Coded(coded.dictionary.to_pylist(), coded.indices, starts)


def _found(data: np.ndarray, offsets: np.ndarray, whole: Sequence[str]) -> Iterable[tuple[int, int]]:
    """Places of strings in single texts, from the left, the longest first."""
    raw = data.tobytes()
    if not any(string.encode() in raw for string in whole):
        return
    strings = sorted((s.encode() for s in whole), key=len, reverse=True)
    pattern = re.compile(b"|".join(map(re.escape, strings)))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        for match in pattern.finditer(raw, a, b):
            yield match.span()


class Kept:
    """Values of pieces that a worker has met, in two generations bounded by bytes.

    ``make`` computes the values of pieces that aren't kept. When the younger
    generation is full it becomes the older one, whose pieces come back if they are met.
    """

    def __init__(self, make: Callable[[list[bytes]], Iterable[bytes]], most: int | None = None):
        self.make, self.most = make, (KEPT_BYTES if most is None else most) // 2
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        young, old = self.young, self.old
        values = list(map(young.get, pieces))
        absent = [k for k, value in enumerate(values) if value is None]
        fresh = []
        for k in absent:
            value = values[k] = old.get(pieces[k])
            if value is None:
                fresh.append(k)
        for k, value in zip(fresh, self.make([pieces[k] for k in fresh]) if fresh else ()):
            values[k] = value
        for k in absent:
            if self.size >= self.most:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[pieces[k]] = values[k]
            self.size += len(pieces[k]) + len(values[k]) + _ENTRY_BYTES
        return values


def gather(values: Sequence[bytes] | pa.Array, index: pa.Array | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values by number, one after another, and where each begins, with the end."""
    if not isinstance(values, pa.Array):
        values = pa.array(values, pa.large_binary())
    taken = values.take(index if isinstance(index, pa.Array) else pa.array(index))
    if not len(taken):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
    held = taken.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
