"""Packed ids against plain calls of the tokenizers library."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemart.llm.ragged import WIDE_SPACES
from lakemart.llm.tokens import Pieces, encoder, public_vocabulary

KINDS = [("word_bpe_49k.json", "<u4"), ("byte_bpe_50k.json", "<u2")]
PARTS = [
    "a", "Word", "don't", " I'll", "été", "É", "Straße", "ſ", "İ", "ΑΣ", "́", "é", " ", "  ", "\n", " \n", "\n\n",
    "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", ".", ",", "!?", "12", "½", "漢字", "🎉", "<|endoftext|>", "_", "'s", "K", "ª",
    "<|startoftext|>", "<|endof", "text|>", " ", "​", "᠎", "”", "a,", "é,", "1.", "x!?”",
]
TEXT = st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=20)
_loaded = {}


def library(name):
    if name not in _loaded:
        _loaded[name] = Tokenizer.from_file(public_vocabulary(name))
    return _loaded[name]


def ids_of(own, texts, dtype):
    data, at = own.packed(pa.array(texts, pa.string()))
    return [np.frombuffer(data[a:b], dtype).tolist() for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize(("name", "dtype"), KINDS)
@settings(max_examples=500, deadline=None)
@given(texts=st.lists(TEXT, max_size=4))
def test_packed_ids(name, dtype, texts):
    own = encoder(Pieces, public_vocabulary(name), dtype)
    expected = [library(name).encode(text, add_special_tokens=False).ids for text in texts]
    assert ids_of(own, texts, dtype) == expected


@pytest.mark.parametrize(("name", "dtype"), KINDS)
def test_given_documents_with_few_pieces_kept(tiny_docs, name, dtype):
    own = Pieces(public_vocabulary(name), dtype, most=20_000)
    texts = list(tiny_docs[1].values())
    expected = [library(name).encode(text, add_special_tokens=False).ids for text in texts]
    for at in range(0, len(texts), 40):
        assert ids_of(own, texts[at : at + 40], dtype) == expected[at : at + 40]


@pytest.mark.parametrize(("name", "dtype"), KINDS)
def test_plain_words_go_straight_to_the_model(name, dtype):
    assert Pieces(public_vocabulary(name), dtype).direct is not None


def test_special_strings_have_their_own_ids():
    text = "hello <|endoftext|> world"
    for (name, dtype), expected in zip(KINDS, ([3306, 49407, 1002], [31373, 220, 50256, 995])):
        assert ids_of(Pieces(public_vocabulary(name), dtype), [text, "hello <|endof", "text|>"], dtype)[0] == expected


def test_white_space_of_the_library_is_known():
    splitter = library("byte_bpe_50k.json").pre_tokenizer
    spaces = [c for c in map(chr, range(0x80, 0x3100)) if len(splitter.pre_tokenize_str(f"a{c}{c}b")) == 4]
    assert sorted(WIDE_SPACES) == sorted(c.encode() for c in spaces)
