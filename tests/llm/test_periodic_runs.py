"""Periodic runs against scans of every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_texts import prose

from lakemart.llm import periodic_runs as module
from lakemart.llm.periodic_runs import collapse_runs, find_runs, periodic_runs, repeated_tail, run_digests


def brute(words, least=12):
    """All runs (start, length, period) by comparing at each lag, with no smaller period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            part = words[at : at + length]
            if length >= max(least, 2 * q) and not any(part[:-p] == part[p:] for p in range(1, q)):
                out.append((at, length, q))
            at = end
    return sorted(out, key=lambda run: (run[0], run[2]))


def found(texts, least=12):
    codes = {}
    words = np.array([codes.setdefault(w, len(codes)) for text in texts for w in text], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
    runs = find_runs(words, starts, least)
    out = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in (runs.text, runs.start, runs.length, runs.period))):
        out[text].append(tuple(run))
    return out


def mixed(rng, n):
    """Words with runs inside runs: pieces of few letters, repeated some times."""
    out = []
    while len(out) < n:
        unit = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.choice([1, 2, 3, 7, 17, 40, 90]))]
        if rng.random() < 0.5:
            unit = unit * rng.randint(1, 4) + unit[: rng.randint(0, len(unit))] + [rng.choice("xyz")]
        times = rng.choice([1, 1, 2, 2, 3, 5])
        out += unit * times + unit[: rng.randint(0, len(unit))]
    return out[:n]


@pytest.mark.parametrize("seed", range(40))
def test_all_runs(seed):
    rng = random.Random(seed)
    texts = [mixed(rng, rng.choice([0, 1, 11, 12, 40, 150, 400])) for _ in range(6)]
    assert found(texts) == [brute(text) for text in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=160), max_size=4))
def test_runs_of_two_words(texts):
    assert found(texts) == [brute(text) for text in texts]


def test_runs_that_meet_inside_short_periods():
    """Around the middle of two stretches of a short period there is a run of each odd length."""
    text = list("ab" * 60 + "a") + list("ab" * 60 + "a")
    assert found([text]) == [brute(text)] and len(found([text])[0]) > 40
    text = list(("a" * 50 + "b") * 3 + "a" * 70 + ("b" + "a" * 50) * 2)
    assert found([text]) == [brute(text)]


def test_fibonacci_and_thue_morse_words():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    morse = [bin(i).count("1") % 2 for i in range(700)]
    texts = [list(b), morse, morse + morse]
    assert found(texts) == [brute(text) for text in texts]


def test_hashes_that_deceive(monkeypatch):
    """With hashes of two bits the word-by-word comparison still decides."""
    real = module._mixed
    monkeypatch.setattr(module._Prefixes, "_equal", lambda self, i, j, size: (
        real((self.sums[i + size] - self.sums[i]) * self.power[j - i]) & np.uint64(3)
        == real(self.sums[j + size] - self.sums[j]) & np.uint64(3)
    ))
    rng = random.Random(3)
    for _ in range(10):
        text = mixed(rng, 300)
        assert found([text]) == [brute(text)]


def test_one_word_over_and_over_makes_few_seeds(monkeypatch):
    seeds, inner = [], module._seeds
    monkeypatch.setattr(module, "_seeds", lambda *a: seeds.append(inner(*a)) or seeds[-1])
    n = 60_000
    assert found([["w"] * n]) == [[(0, n, 1)]]
    assert sum(len(at) for at, _ in seeds) == 0
    text = (["w"] * 400 + ["x"]) * (n // 401)
    assert (0, len(text), 401) in found([text])[0]
    assert sum(len(at) for at, _ in seeds) < 4 * n


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, sha(lines), sha(kept)), kept, runs


def check(docs):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    expected = [expected_row(*row) for row in rows]
    result = run_digests(docs, order=repeated_tail)
    assert sorted(repr(tuple(row)) for row in result.collect()) == sorted(repr(row) for row, _, _ in expected)
    texts = collapse_runs(docs, order=repeated_tail).collect()
    assert sorted(repr(tuple(r)) for r in texts) == sorted(repr((row[0], kept)) for row, kept, _ in expected)
    listed = periodic_runs(docs, order=repeated_tail).collect()
    assert sorted(repr(tuple(r)) for r in listed) == sorted(
        repr((row[0], *run)) for row, _, runs in expected for run in runs
    )
    return result


def test_given_documents(tiny_docs):
    docs = tiny_docs[0].where("length(text) < 12000")
    assert docs.count() > 150
    check(docs)


def test_a_long_given_document(tiny_docs):
    """The planted tail of a long text is found, and nothing lies outside it in other texts."""
    texts = sorted(tiny_docs[1].values(), key=len)[-3:]
    words = [text.split() for text in texts]
    planted = [w[:500] + w[500:2000] * 3 + w[500:900] for w in words if len(w) > 2000]
    assert planted
    for text, runs in zip(planted, found(planted)):
        assert any(s <= 500 and length >= 4900 and q == 1500 for s, length, q in runs)


def test_odd_documents(odd_docs):
    check(odd_docs.where("doc_id is null or doc_id != 7"))
    assert run_digests(odd_docs).count() == odd_docs.count()


def test_planted_tails_and_repeats(make_docs):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, prose(5 + 7 * k, k)) for k, i in enumerate(ids)] + [(1, ""), (2, "a " * 30), (2, "a\tb\n" * 6)]
    check(make_docs(*rows))


def test_no_documents(no_docs):
    assert run_digests(no_docs).collect() == [] and periodic_runs(no_docs).collect() == []
