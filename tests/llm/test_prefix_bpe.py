"""BPE by the walk over a trie against the tokenizers library."""

import hashlib
import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_tokens import PARTS
from tokenizers import Tokenizer

from lakemart.llm import prefix_bpe
from lakemart.llm.prefix_bpe import Bpe, decode, encode, round_trip_digests
from lakemart.llm.tokens import encoder, public_vocabulary

PATH = public_vocabulary("byte_bpe_50k.json")
TEXT = (
    st.lists(st.sampled_from(PARTS), max_size=12).map("".join)
    | st.text(max_size=20)
    | st.text(st.sampled_from("aeinorst ther ing"), max_size=40)
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def columns_of(own, texts):
    ids, starts = own.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])], own.decode(ids, starts).to_pylist()


@settings(max_examples=600, deadline=None)
@given(texts=st.lists(TEXT, max_size=4))
def test_ids_and_round_trip(library, texts):
    expected = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert columns_of(encoder(Bpe, PATH), texts) == (expected, texts)


def test_every_token_string_is_encoded_as_the_library_does(library):
    """All entries of the vocabulary, also those that no text can reach, alone and in pairs."""
    own, rng = encoder(Bpe, PATH), random.Random(1)
    strings = sorted(own.vocab)
    words = strings + [a + b for a, b in zip(strings, rng.sample(strings, len(strings)))]
    found = own.walk(words)
    assert all(found[w] == [t.id for t in library.model.tokenize(w)] for w in words)


def test_bytes_that_are_no_text(library):
    own, rng = encoder(Bpe, PATH), random.Random(2)
    runs = [[rng.randrange(50257) for _ in range(rng.randrange(12))] for _ in range(500)]
    encoded = pa.array([i for run in runs for i in run], pa.int64()).to_numpy()
    starts = [0]
    for run in runs:
        starts.append(starts[-1] + len(run))
    expected = [library.decode(run, skip_special_tokens=False) for run in runs]
    assert own.decode(encoded, pa.array(starts).to_numpy()).to_pylist() == expected


def check(docs, library):
    rows = [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        expected.append((doc_id, len(ids), *digests))
    found = [tuple(row) for row in round_trip_digests(docs, PATH).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_given_documents(library, tiny_docs):
    docs, texts = tiny_docs
    check(docs, library)
    encoded = encode(docs, PATH)
    assert {row.doc_id: row.ids for row in encoded.collect()} == {
        i: library.encode(text, add_special_tokens=False).ids for i, text in texts.items()
    }
    assert {row.doc_id: row.text for row in decode(encoded, PATH).collect()} == texts


def test_odd_documents(library, odd_docs):
    check(odd_docs, library)


def test_special_strings(library, make_docs):
    texts = ["<|endoftext|>", "a <|endoftext|>  b\n<|endoftext|><|endoftext|>", "<|endof", "text|>", " <|endoftext|> "]
    check(make_docs(*enumerate(texts)), library)


def test_no_documents(no_docs):
    assert round_trip_digests(no_docs, PATH).collect() == [] and encode(no_docs, PATH).collect() == []


def test_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [31373, 220])], "doc_id long, ids array<int>")
    assert {row.doc_id: row.text for row in decode(df, PATH).collect()} == {1: None, 2: "", 3: "hello "}


def test_little_is_kept(library, tiny_docs, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "KEPT_PAIRS", 50)
    own, texts = Bpe(PATH, 3000), list(tiny_docs[1].values())[:20]
    for text in texts:
        assert columns_of(own, [text])[0] == [library.encode(text, add_special_tokens=False).ids]


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        Bpe(public_vocabulary("word_bpe_49k.json"))
    settings = json.loads(open(PATH).read())
    vocab = settings["model"]["vocab"]
    made = {tuple(merge) for merge in map(tuple, settings["model"]["merges"])}
    other = next([w[0], w[1:]] for w in vocab if len(w) > 2 and w[1:] in vocab and (w[0], w[1:]) not in made)
    settings["model"]["merges"].append(other)
    (tmp_path / "twice.json").write_text(json.dumps(settings))
    with pytest.raises(ValueError):
        Bpe(str(tmp_path / "twice.json"))
