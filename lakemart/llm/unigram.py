"""The pieces of a SentencePiece file as a unigram model: vocabulary, marks, tie rules.

The given file's pieces and scores are read as they are, but for pieces with a
score below ``NEVER``, the file's way to put them last: they come one after the
worst of the others, as sums with such numbers lose the rest. A best segmentation has
the highest sum of scores; among equal ones the choice is made from the front, and
the piece that ends at a place is the longest one that reaches the best sum there,
as in the SentencePiece library's unigram encoder. A character without a piece
costs ``UNKNOWN_COST`` more than the worst score and becomes byte pieces.

Text is normalised as the file says: a mark stands for each space, and one is put
before a text that isn't empty. No piece holds a mark after another character, so
a text falls apart into words, each with the marks before it, that are segmented
by themselves; scores are whole numbers, so sums are exact.
"""

from __future__ import annotations

import re

import numpy as np

MARK = "▁"
UNKNOWN_COST = 10.0
NEVER = -1e6

_WORD = re.compile(MARK + "+[^" + MARK + "]*|[^" + MARK + "]+")


class Vocabulary:
    """Pieces with scores and ids; byte pieces by value."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.piece: list[str] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.piece.append(piece)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.score[piece], self.id[piece] = model.get_score(i), i
        last = min(score for score in self.score.values() if score > NEVER) - 1
        self.score = {piece: max(score, last) for piece, score in self.score.items()}
        if any(MARK in piece.lstrip(MARK) for piece in self.score):
            raise ValueError("a piece spans words")
        self.unknown = min(self.score.values()) - UNKNOWN_COST
        #: every end of a piece, with the score if it is a piece itself
        self.ending: dict[str, float | None] = {}
        for piece in self.score:
            for start in range(len(piece)):
                self.ending.setdefault(piece[start:], None)
        self.ending.update(self.score)
        self.bytes_of = [piece.replace(MARK, " ").encode() for piece in self.piece]
        #: by id; a character without a piece has its cost at the first of its bytes
        self.score_of = np.zeros(len(self.piece))
        for piece, i in self.id.items():
            self.score_of[i] = self.score[piece]
        for value, i in enumerate(self.byte):
            self.bytes_of[i] = bytes([value])
            if not 0x80 <= value < 0xC0:
                self.score_of[i] = self.unknown


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def marked_words(text: str) -> list[str]:
    """The words of a text, each with the marks before it; joined they are the marked text."""
    return _WORD.findall(marked(text))


_made: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per process."""
    if path not in _made:
        _made[path] = Vocabulary(path)
    return _made[path]
