"""Ids of whole texts by the tokenizers library, a chunk of texts at a time.

Texts are cut where both tokenizers have a border (``ragged.spaced``), so the ids of a
piece don't depend on its neighbours. Only distinct pieces go to the library. Strings
of added tokens, such as ``<|endoftext|>``, are pieces of their own and have the ids
that a plain call gives them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lakemart.llm.ragged import Kept, code, gather, spaced


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies use for each byte, by code point."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + k) for k, byte in enumerate(rest)}


_CHARACTER = byte_characters()

#: Letters that normal forms leave alone, after one space at most.
_SIMPLE = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)")
_PROBES = ("word", " Word", "Straße", " ÉTÉ", "añejo", " X", "x")


def added_strings(tokenizer) -> list[str]:
    """The strings that the library looks for in a text before all else."""
    added = json.loads(tokenizer.to_str())["added_tokens"]
    for token in added:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError("added tokens that take their surroundings aren't supported")
        if token["normalized"] and tokenizer.normalizer is not None:
            raise ValueError("added tokens that are looked for in normal forms aren't supported")
    return [token["content"] for token in added]


class Pieces:
    """Packed ids under a tokenizer file whose words end at white space.

    A piece of plain letters needs neither the normaliser nor the splitter, so it goes
    straight to the library's BPE model, which takes a third of the time; whether
    that holds for a file, and whether spaces or letter case count, is tried on words.
    """

    def __init__(self, path: str, dtype: str, most: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.model, self.added = self.tokenizer.model, added_strings(self.tokenizer)
        kinds = ((space, lower) for space in (True, False) for lower in (False, True))
        self.direct = next((kind for kind in kinds if self._holds(*kind)), None)
        self.kept = Kept(self._encode, most)

    def _holds(self, space: bool, lower: bool) -> bool:
        return all(
            self._model_ids(*_SIMPLE.fullmatch(w).groups(), space, lower) == self._library_ids(w) for w in _PROBES
        )

    def _model_ids(self, before: str, letters: str, space: bool, lower: bool) -> list[int]:
        text = (before if space else "") + (letters.lower() if lower else letters)
        if space or not text.isascii():
            text = "".join([_CHARACTER[byte] for byte in text.encode()])
        return [token.id for token in self.model.tokenize(text)]

    def _library_ids(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _encode(self, pieces: list[bytes]) -> Iterator[bytes]:
        for piece in map(bytes.decode, pieces):
            simple = _SIMPLE.fullmatch(piece) if self.direct else None
            ids = self._model_ids(*simple.groups(), *self.direct) if simple else self._library_ids(piece)
            yield np.array(ids, self.dtype).tobytes()

    def packed(self, text: pa.Array) -> tuple[memoryview, list[int]]:
        """The ids of all texts as bytes, and where each text's begin, with the end."""
        coded = code(text, spaced, self.added)
        data, offsets = gather(self.kept(coded.distinct), coded.index)
        return memoryview(data), offsets[coded.starts].tolist()


_made: dict[tuple, object] = {}


def encoder(kind: type, path: str, *settings):
    """One per worker process, so that tasks that follow each other share it."""
    key = (kind, path, *settings)
    if key not in _made:
        _made[key] = kind(path, *settings)
    return _made[key]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def public_vocabulary(name: str) -> str:
    """The place of a public vocabulary file; callers may pass any other path."""
    import public_tokenizers

    return public_tokenizers.path(name)
