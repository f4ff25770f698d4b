"""Byte-level BPE encoding and decoding by a walk over a trie of words (operator 11).

Method. The encoding of a word is fixed by one number per prefix: the last token of
the prefix's own encoding. What precedes that token is the encoding of a shorter
prefix. A token ends a prefix if its bytes do, and if it and the last token before it
stay apart: no merge across their border comes before the merges that made them. That
holds for exactly one token. The distinct words of a chunk are sorted, which is the order
in which a depth-first walk meets them in their trie; the walk keeps the last token at each
depth, so a prefix that words share is worked out once.

Texts are cut at borders that the tokenizer has as well (``ragged.spaced``); the
library's own splitter cuts rarer pieces further into words. Strings of added
tokens in a text are those tokens, as in a plain call. Decoding takes the bytes of each
token for a whole column; bytes that are no UTF-8 become U+FFFD.

Defined cases. Null text is empty and has no ids; it decodes to empty text. Null ids
give null text. Rows that repeat an id are encoded each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakemart.llm.common import chunks, id_and_text
from lakemart.llm.ragged import PIECE_CHUNK, Kept, code, gather, spaced
from lakemart.llm.tokens import added_strings, byte_characters, encoder

#: Pairs of tokens that a worker remembers; beyond that it starts anew, which changes no result.
KEPT_PAIRS = 400_000

_SIMPLE = re.compile(rb" ?[A-Za-z]+")


class Bpe:
    """Vocabulary and merges of a byte-level BPE file; encodes and decodes whole columns."""

    def __init__(self, path: str, most: int | None = None):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        settings = json.loads(tokenizer.to_str())
        model, splitter = settings["model"], settings["pre_tokenizer"]
        self.character = byte_characters()
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        joined = {a + b for a, b in merges}
        unlike = (
            splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"],
            settings["normalizer"] is not None or settings["post_processor"] is not None,
            model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"),
            len(joined) != len(merges) or not {*self.character.values()} <= self.vocab.keys(),
        )
        if any(unlike):
            raise ValueError("not a byte-level BPE file with one merge per token")
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        added = added_strings(tokenizer)
        self.added = {string.encode(): tokenizer.token_to_id(string) for string in added}

        size = tokenizer.get_vocab_size()
        #: when a token is made; its two parts; when a pair is merged
        self.made, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.pair: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            token = self.vocab[a + b]
            self.left[token], self.right[token] = pair = self.vocab[a], self.vocab[b]
            self.made[token] = self.pair[pair] = rank
        #: every end of a token's string, with the token if it is one itself
        self.ending: dict[str, int] = {}
        for string in self.vocab:
            for start in range(1, len(string)):
                self.ending.setdefault(string[start:], -1)
        self.length = [0] * size
        for string, token in self.vocab.items():
            self.ending[string], self.length[token] = token, len(string)
        byte_of = {character: byte for byte, character in self.character.items()}
        strings = [tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes_of = pa.array(
            [bytes(map(byte_of.get, s)) if byte_of.keys() >= set(s) else s.encode() for s in strings],
            pa.large_binary(),
        )
        self.decimal = pa.array([b",%d" % i for i in range(size)], pa.large_binary())
        self.whole: dict[int, bool] = {}
        self.apart: dict[tuple[int, int], bool] = {}
        self.kept = Kept(self._make, most)

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether the encoding of two tokens' bytes in a row is these two tokens.

        Takes merges back, the latest first, and looks at the pairs that then meet at
        the border. Of equal pairs in a row the left one is merged first.
        """
        end_a = end_b = math.inf  # when a and b become parts of what they are in
        while True:
            rank = self.pair.get((a, b))
            if rank is not None and rank < end_a and rank <= end_b:
                return False
            if self.made[a] > self.made[b]:
                end_a, a = self.made[a], self.right[a]
            elif self.made[b] >= 0:
                end_b, b = self.made[b], self.left[b]
            else:
                return True

    def _is_whole(self, token: int) -> bool:
        """Whether the encoding of a token's bytes is that token: some can't be reached."""
        if self.made[token] < 0:
            return True
        a, b, made = self.left[token], self.right[token], self.made[token]
        if not (self._whole(a) and self._whole(b)):
            return False
        # the parts must still be there when they are merged
        del self.pair[a, b]
        try:
            return self._stay_apart(a, b)
        finally:
            self.pair[a, b] = made

    def _whole(self, token: int) -> bool:
        if token not in self.whole:
            self.whole[token] = self._is_whole(token)
        return self.whole[token]

    def walk(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each word (bytes as characters), by one walk over their trie."""
        ending, apart, whole, length = self.ending, self.apart, self._whole, self.length
        last = [-1]  # by depth: the last token of the prefix that ends there
        out = {}
        before = ""
        for word in sorted(set(words)):
            depth = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                depth += 1
            del last[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                start = end
                while True:
                    start -= 1
                    token = ending[word[start:end]]
                    if token < 0:
                        continue
                    if not start:
                        if whole(token):
                            break
                        continue
                    pair = last[start], token
                    fits = apart.get(pair)
                    if fits is None:
                        if len(apart) >= KEPT_PAIRS:
                            apart.clear()
                        fits = apart[pair] = whole(token) and self._stay_apart(*pair)
                    if fits:
                        break
                last.append(token)
            ids: list[int] = []
            end = len(word)
            while end:
                ids.append(last[end])
                end -= length[last[end]]
            out[word] = ids[::-1]
            before = word
        return out

    def _make(self, pieces: list[bytes]) -> Iterator[bytes]:
        words_of: list[list[str]] = []
        for piece in pieces:
            if piece in self.added:
                words_of.append([])
            elif _SIMPLE.fullmatch(piece):
                words_of.append([piece.decode().replace(" ", self.character[32])])
            else:
                words_of.append([word for word, _ in self.split(piece.decode())])
        ids_of = self.walk(word for words in words_of for word in words)
        for piece, words in zip(pieces, words_of):
            ids = [i for word in words for i in ids_of[word]] if words else [self.added[piece]]
            yield np.array(ids, "<u4").tobytes()

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where each text's begin, with the end."""
        coded = code(text, spaced, [string.decode() for string in self.added])
        data, offsets = gather(self.kept(coded.distinct), coded.index)
        return data.view("<u4"), offsets[coded.starts] // 4

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The text of each run of ids."""
        data, offsets = gather(self.bytes_of, ids)
        bounds = np.ascontiguousarray(offsets[starts])
        held = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        raw = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, held)
        try:
            return raw.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())

    def decimals(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[memoryview]:
        """The ids of each run as decimal numbers, joined by commas."""
        data, offsets = gather(self.decimal, ids)
        held, bounds = memoryview(data), offsets[starts].tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield held[a + 1 : b]


def _texts(path: str, columns: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(Bpe, path)
        for batch in chunks(batches, PIECE_CHUNK):
            ids, starts = own.encode(batch.column("text"))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **columns(own, ids, starts)})

    return run


def _ids(own: Bpe, ids: np.ndarray, starts: np.ndarray) -> dict[str, pa.Array]:
    lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
    return {"ids": lists}


def _digests(own: Bpe, ids: np.ndarray, starts: np.ndarray) -> dict[str, pa.Array]:
    decoded = own.decode(ids, starts)
    return {
        "n_tokens": pa.array(np.diff(starts), pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in own.decimals(ids, starts)], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded], pa.string()),
    }


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array) of every text."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_texts(path, _ids), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of encoded documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(Bpe, path)
        for batch in batches:
            lists = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            text = own.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), starts)
            text = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), text.cast(pa.string()))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": text})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ids of every text, and what they decode to.

    The first digest is over the decimal ids joined by commas, the second over the
    decoded text in UTF-8.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _texts(path, _digests), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
