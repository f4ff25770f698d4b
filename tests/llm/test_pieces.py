"""SentencePiece pieces and token counts against the library."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm.count_tokens import Counting, token_counts
from lakemart.llm.shared_prefix import Encoder, decode, encode, encode_summary, segment
from lakemart.llm.tokens import public_vocabulary
from lakemart.llm.unigram import MARK, NEVER, marked_words, vocabulary

PATH = public_vocabulary("piece_bpe_32k.model")
TEXTS = st.text(st.sampled_from("aeinorst the ing \n\t.é漢🎉0xABß") | st.characters(exclude_categories=["Cs"], exclude_characters=MARK + "\x00"), max_size=40)


@pytest.fixture(scope="module")
def library():
    """The library's unigram encoder on the same pieces."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    last = min(vocabulary(PATH).score.values())
    for piece in model.pieces:
        if piece.score < NEVER:
            piece.score = last
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def ids_of(text):
    words = marked_words(text)
    found = segment(words, vocabulary(PATH))
    return [i for word in words for i in found[word]]


def columns_of(texts, most=None):
    """Ids of texts as whole columns, and what they decode to."""
    own = Encoder(PATH, most)
    ids, starts = own.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])], own.decode(ids, starts).to_pylist()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_counts_and_round_trip(library, text):
    ids = ids_of(text)
    assert ids == library.encode(text)
    assert Counting(PATH).text(text)[1] == len(ids)
    assert columns_of(["", text, " " + text]) == ([[], ids, ids_of(" " + text)], ["", text, " " + text])


def test_counts_equal_pieces_word_by_word(tiny_docs):
    words = {word for text in tiny_docs[1].values() for word in marked_words(text)}
    counting = Counting(PATH)
    for word, ids in segment(words, vocabulary(PATH)).items():
        assert counting.word(word) == (vocabulary(PATH).score_of[ids].sum(), len(ids))


def test_given_documents(library, tiny_docs):
    docs, texts = tiny_docs
    expected = {i: library.encode(text) for i, text in texts.items()}
    found = {row.doc_id: row for row in encode(docs, PATH).collect()}
    assert {i: row.ids for i, row in found.items()} == expected
    assert all(row.exact and row.n_tokens == len(row.ids) for row in found.values())
    for row in found.values():
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
    counts = {row.doc_id: (row.n_tokens, row.score) for row in token_counts(docs, PATH).collect()}
    assert counts == {i: (row.n_tokens, row.score) for i, row in found.items()}
    assert {row.doc_id: row.text for row in decode(encode(docs, PATH), PATH).collect()} == texts
    decoded = {row.doc_id: row.decoded_crc32 for row in encode_summary(docs, PATH).collect()}
    assert decoded == {i: zlib.crc32(text.encode()) for i, text in texts.items()}


def test_odd_documents(library, odd_docs):
    texts = [(row.doc_id, row.text or "") for row in odd_docs.select("doc_id", "text").collect()]
    # the library stops at a null character, so that text is left out
    expected = sorted(repr((i, len(library.encode(t)))) for i, t in texts if "\x00" not in t)
    for result in (encode_summary(odd_docs, PATH), token_counts(odd_docs, PATH)):
        found = [(row.doc_id, row.n_tokens) for row in result.collect()]
        assert sorted(repr(x) for x in found if x[0] != 8) == expected
        assert len(found) == len(texts)


def test_a_text_with_the_mark_itself(make_docs):
    (row,) = encode(make_docs((1, f"a{MARK}b")), PATH).collect()
    assert not row.exact and columns_of([f"a{MARK}b"]) == ([row.ids], ["a b"])


def test_no_documents(no_docs):
    assert encode(no_docs, PATH).collect() == [] and token_counts(no_docs, PATH).collect() == []


def test_pieces_kept_by_workers_change_nothing(monkeypatch, tiny_docs):
    from lakemart.llm import count_tokens

    monkeypatch.setattr(count_tokens, "KEPT_BYTES", 2000)
    texts = list(tiny_docs[1].values())[:30]
    assert Counting(PATH).text(texts[0])[1] == len(ids_of(texts[0]))
    own = Encoder(PATH, 5000)
    for text in texts:
        ids, _ = own.encode(pa.array([text]))
        assert ids.tolist() == ids_of(text)
