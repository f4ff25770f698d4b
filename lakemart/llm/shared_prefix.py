"""SentencePiece encoding and decoding by a shared-prefix Viterbi (operator 6).

Method. The distinct marked words of a batch are sorted, which is the order in
which a depth-first walk meets them in their trie. The walk keeps the best sum of
scores at each depth; from one word to the next only what follows their common
prefix is computed anew. The ids of words are then put together per text.

Segmentation and ties are those of ``unigram.py``. A text that holds the mark
itself decodes with a space in its place; all other texts decode to what they
were, which ``exact`` tells.

Defined cases. Null text is empty and has no ids. Rows that repeat an id are
encoded each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakemart.llm.common import chunks, id_and_text, per_text
from lakemart.llm.ragged import PIECE_CHUNK, Kept, code, gather, space_runs
from lakemart.llm.tokens import encoder
from lakemart.llm.unigram import MARK, Vocabulary, vocabulary


def segment(words: Iterable[str], vocab: Vocabulary) -> dict[str, list[int]]:
    """Ids of each word, by one walk over their trie."""
    ending, id_of, unknown = vocab.ending, vocab.id, vocab.unknown
    best = [0.0]  # by depth: the best sum of scores of the first characters
    begin = [0]  # and where the piece that ends there begins
    out = {}
    before = ""
    for word in sorted(set(words)):
        depth = 0
        for a, b in zip(before, word):
            if a != b:
                break
            depth += 1
        del best[depth + 1 :], begin[depth + 1 :]
        for end in range(depth + 1, len(word) + 1):
            top, at = None, end - 1
            for start in range(end - 1, -1, -1):
                score = ending.get(word[start:end], False)
                if score is False:
                    break  # no piece ends like this, so no longer one does
                if score is None:
                    continue
                total = best[start] + score
                # of equal sums the longest piece stays
                if top is None or total >= top:
                    top, at = total, start
            if word[end - 1] not in id_of:
                total = best[end - 1] + unknown
                if top is None or total > top:
                    top, at = total, end - 1
            best.append(top)
            begin.append(at)
        ids: list[int] = []
        end = len(word)
        while end:
            start = begin[end]
            piece = word[start:end]
            if piece in id_of:
                ids.append(id_of[piece])
            else:
                ids += [vocab.byte[b] for b in reversed(piece.encode())]
            end = start
        out[word] = ids[::-1]
        before = word
    return out


class Encoder:
    """Packed ids of whole columns of text, and texts of ids."""

    def __init__(self, path: str, most: int | None = None):
        self.vocab = vocabulary(path)
        self.kept = Kept(self._make, most)
        self.bytes_of = pa.array(self.vocab.bytes_of, pa.large_binary())

    def _make(self, pieces: list[bytes]) -> list[bytes]:
        words = [piece.decode().replace(" ", MARK) for piece in pieces]
        found = segment(words, self.vocab)
        return [np.array(found[word], "<u4").tobytes() for word in words]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where each text's begin, with the end."""
        # a mark stands for a space, and one comes before a text that isn't empty
        plain = pc.replace_substring(text.cast(pa.large_string()), MARK, " ")
        space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        before = pc.if_else(pc.equal(pc.binary_length(plain), 0), nothing, space)
        marked = pc.binary_join_element_wise(before, plain, nothing)
        coded = code(marked, space_runs)
        data, offsets = gather(self.kept(coded.distinct), coded.index)
        return data.view("<u4"), offsets[coded.starts] // 4

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The text of each run of ids, without the space that a first mark stands for."""
        data, offsets = gather(self.bytes_of, ids)
        bounds = offsets[starts]
        begins = bounds[:-1].copy()
        filled = np.flatnonzero(np.diff(bounds))
        begins[filled] += data[begins[filled]] == 32
        held = memoryview(data)
        return pa.array(
            [str(held[a:b], "utf-8", "replace") for a, b in zip(begins.tolist(), bounds[1:].tolist())],
            pa.string(),
        )


def _encode(path: str, with_ids: bool) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(Encoder, path)
        scores = own.vocab.score_of
        for batch in chunks(batches, PIECE_CHUNK):
            text = batch.column("text")
            ids, starts = own.encode(text)
            held, bounds = memoryview(ids.view(np.uint8)), (4 * starts).tolist()
            crcs = [zlib.crc32(held[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(starts), pa.int64()),
                "score": pa.array(per_text(scores[ids], starts), pa.float64()),
                "ids_crc32": pa.array(crcs, pa.int64()),
            }
            if with_ids:
                lists = pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(*lists)
            decoded = own.decode(ids, starts)
            columns["exact"] = pc.equal(decoded, text.cast(pa.string()))
            if not with_ids:
                columns["decoded_crc32"] = pa.array(
                    [zlib.crc32(x.as_buffer()) for x in decoded], pa.int64()
                )
            yield pa.record_batch(columns)

    return encode


_SUMMARY = "doc_id long, n_tokens long, score double, ids_crc32 long"


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, score, ids_crc32, ids, exact (whether the ids decode to the text)."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _encode(model_path, True), f"{_SUMMARY}, ids array<int>, exact boolean"
    )


def encode_summary(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The same with a checksum of the decoded text in UTF-8 in place of the ids."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _encode(model_path, False), f"{_SUMMARY}, exact boolean, decoded_crc32 long"
    )


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of encoded documents; null ids give null text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(Encoder, model_path)
        for batch in batches:
            lists = batch.column("ids")
            ids = np.array(lists.flatten(), dtype=np.int64)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            decoded = own.decode(ids, np.concatenate([[0], np.cumsum(sizes)]))
            decoded = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), decoded)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": decoded})

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")
