"""Token counts without tokens: a count-only Viterbi (operator 10).

Method. An Aho-Corasick automaton over the unigram vocabulary lists all pieces
that end at each character of a word. Dynamic programming carries the best sum of
scores and the number of pieces of the path that the tokenizer would choose; no
path is kept. Ties follow ``unigram.py``: of equal sums the longest last piece.
A character without a piece counts as many pieces as it has UTF-8 bytes.

Counts of words are kept by worker up to a bound in bytes, as words recur.

Defined cases. Null text is empty and has no token. Rows that repeat an id are
counted each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from lakemart.llm.common import chunks, id_and_text
from lakemart.llm.unigram import marked_words, vocabulary

#: Bytes of words and their counts that a worker keeps, with what Python adds to each.
KEPT_BYTES = 64 << 20
_ENTRY_BYTES = 280


class Counting:
    """Scores and numbers of pieces of words under a vocabulary."""

    def __init__(self, path: str):
        vocab = vocabulary(path)
        self.unknown = vocab.unknown
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocab.score.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.kept: dict[str, tuple[float, int]] = {}
        self.size = 0

    def word(self, word: str) -> tuple[float, int]:
        """Best sum of scores and number of pieces."""
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        pieces = [0] * (n + 1)
        matches = self.automaton.iter(word)
        found = next(matches, None)
        for end in range(1, n + 1):
            single = False
            top, count, last = None, 0, 0
            while found is not None and found[0] == end - 1:
                length, score = found[1]
                single = single or length == 1
                total = best[end - length] + score
                if top is None or total > top or (total == top and length > last):
                    top, count, last = total, pieces[end - length] + 1, length
                found = next(matches, None)
            if not single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    top, last = total, 1
                    count = pieces[end - 1] + len(word[end - 1].encode())
            best[end], pieces[end] = top, count
        return best[n], pieces[n]

    def text(self, text: str) -> tuple[float, int]:
        total, n = 0.0, 0
        kept = self.kept
        for word, times in Counter(marked_words(text)).items():
            found = kept.get(word)
            if found is None:
                self.size += _ENTRY_BYTES + 4 * len(word)
                if self.size > KEPT_BYTES:
                    kept.clear()
                    self.size = _ENTRY_BYTES + 4 * len(word)
                found = kept[word] = self.word(word)
            total += times * found[0]
            n += times * found[1]
        return total, n


_made: dict[str, Counting] = {}


def _count(path: str) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _made:
            _made[path] = Counting(path)
        counting = _made[path]
        for batch in chunks(batches):
            found = [counting.text(text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([n for _, n in found], pa.int64()),
                    "score": pa.array([float(s) for s, _ in found], pa.float64()),
                }
            )

    return count


def token_counts(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens and score of the best segmentation."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _count(model_path), "doc_id long, n_tokens long, score double"
    )
