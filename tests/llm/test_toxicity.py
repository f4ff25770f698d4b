"""Toxicity: held-out accuracy, the label model, and that inputs are texts only."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import toxicity as module
from lakemart.llm.common import Steps, table
from lakemart.llm.toxicity import VOTERS, LabelModel, drop_toxic, toxicity


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def given(spark, small):
    return table(spark, small, "documents"), table(spark, small, "labels")


def test_held_out_accuracy(given):
    docs, labels = given
    found = {row.doc_id: row for row in toxicity(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.7) for row in found.values())
    assert all(row.held_out == held_out(i) for i, row in found.items())
    truth = [(row.toxic, found[row.doc_id].predicted) for row in labels.collect() if held_out(row.doc_id)]
    wrong = sum(t == 0 and p == 1 for t, p in truth)
    caught = sum(t == 1 and p == 1 for t, p in truth)
    assert wrong == 0 and caught >= 0.75 * sum(t for t, _ in truth)


def test_held_out_labels_and_other_columns_are_not_used(spark, given):
    docs, labels = given
    flipped = labels.selectExpr(
        "doc_id", "quality",
        "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic",
    )
    other = docs.selectExpr("doc_id", "text", "'zz' as lang", "'s' as source", "1 as n_chars")
    assert sorted(map(tuple, toxicity(docs, labels).collect())) == sorted(map(tuple, toxicity(other, flipped).collect()))


def test_odd_documents(spark, odd_docs, given):
    found = toxicity(odd_docs, given[1]).collect()
    assert len(found) == odd_docs.count() and all(0 <= row.score <= 1 for row in found)
    blank = {row.score for row in found if row.doc_id in (1, 2, 3)}
    assert len(blank) == 1 and blank.pop() < 0.5


def test_without_usable_labels(spark, make_docs):
    docs = make_docs(*[(i, "a calm text about the sea") for i in range(20)], (50, "you are a stupid idiot and a moron"))
    for rows in ([], [(1, 0), (2, 0)], [(None, 1), (3, None), (4, 7)]):
        labels = spark.createDataFrame([(i, 1, t) for i, t in rows], "doc_id long, quality int, toxic int")
        found = {row.doc_id: row.score for row in toxicity(docs, labels).collect()}
        assert max(found, key=found.get) == 50 and all(p < 0.5 for i, p in found.items() if i != 50)


def test_no_documents(spark, no_docs, given):
    assert toxicity(no_docs, given[1]).collect() == []


def simulated(seed, n=40_000, voters=VOTERS):
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.1
    hit = np.where(truth[:, None], np.linspace(0.9, 0.3, voters), 0.005)
    return truth, rng.random((n, voters)) < hit


def fitted(votes):
    voters = votes.shape[1]
    patterns, counts = np.unique(votes @ (1 << np.arange(voters)), return_counts=True)
    return LabelModel(patterns, counts.astype(float), voters), patterns, counts


def test_the_label_model_finds_accuracies_and_correlations():
    truth, votes = simulated(1)
    votes[:, 5] = votes[:, 4]  # one says what another says
    model, _, _ = fitted(votes)
    assert model.prior == pytest.approx(0.1, abs=0.01)
    assert model.hit[0] == pytest.approx(0.9, abs=0.03) and model.hit[15] == pytest.approx(0.3, abs=0.03)
    assert model.pairs == [(4, 5)] and model.correlation[4, 5] > 0.9
    guessed = model.posterior(votes.astype(float)) > 0.5
    assert (guessed == truth).mean() > 0.99


@pytest.mark.parametrize("seed", range(3))
def test_copies_of_a_voter_move_a_posterior_no_more_than_one(seed):
    _, votes = simulated(seed, voters=4)
    alone, patterns, _ = fitted(votes)
    twice, _, _ = fitted(np.column_stack([votes, votes[:, 1]]))
    thrice, _, _ = fitted(np.column_stack([votes, votes[:, 1], votes[:, 1]]))
    assert twice.pairs == [(1, 4)] and len(thrice.pairs) == 3
    table = (patterns[:, None] >> np.arange(4) & 1).astype(float)
    expected = alone.posterior(table)
    for model, copies in ((twice, 1), (thrice, 2)):
        found = model.posterior(np.column_stack([table, *[table[:, 1]] * copies]))
        assert found == pytest.approx(expected, abs=0.02)


def likelihood(terms, shared, pairs, prior, patterns, counts):
    """The log-likelihood of votes by sums over all patterns, in plain Python."""
    voters, total = len(terms[0]), 0.0
    weigh = lambda p, side: math.exp(
        sum(terms[side][j] for j in range(voters) if p >> j & 1)
        + sum(s for s, (j, k) in zip(shared, pairs) if p >> j & p >> k & 1)
    )
    sums = [sum(weigh(p, side) for p in range(1 << voters)) for side in (0, 1)]
    for p, n in zip(patterns.tolist(), counts.tolist()):
        total += n * math.log((1 - prior) * weigh(p, 0) / sums[0] + prior * weigh(p, 1) / sums[1])
    return total


def test_the_fit_is_a_maximum_of_the_likelihood():
    rng = np.random.default_rng(5)
    _, votes = simulated(5, n=60_000, voters=5)
    votes[:, 3] |= votes[:, 2] & (rng.random(len(votes)) < 0.7)  # agrees beyond what the label explains
    votes[:, 4] ^= votes[:, 3] & (rng.random(len(votes)) < 0.3)
    model, patterns, counts = fitted(votes)
    assert (2, 3) in model.pairs
    held = model.terms, model.shared, model.pairs, model.prior, patterns, counts
    best = likelihood(*held)
    for side in (0, 1):
        for j in range(5):
            for step in (-0.3, 0.3):
                terms = model.terms.copy()
                terms[side, j] += step
                assert likelihood(terms, *held[1:]) < best + 0.1
    for e in range(len(model.pairs)):
        for step in (-0.3, 0.3):
            shared = model.shared.copy()
            shared[e] += step
            assert likelihood(model.terms, shared, *held[2:]) < best + 0.1
    # the posterior is Bayes' rule on the same sums
    table = (patterns[:, None] >> np.arange(5) & 1).astype(float)
    one = np.array([1])
    for p, found in zip(patterns, model.posterior(table)):
        both = likelihood(*held[:4], np.array([p]), one)
        toxic = likelihood(*held[:3], 1 - 1e-300, np.array([p]), one) + math.log(model.prior)
        assert found == pytest.approx(math.exp(toxic - both), abs=1e-9)


def test_entries_by_significance(spark):
    rows = [(t, o) for t in (1, 3, 5, 40, 300) for o in (0, 1, 10, 300)]
    frame = spark.createDataFrame(rows, "toxic long, other long")
    found = frame.select("toxic", "other", module.ratio(F.col("toxic"), F.col("other"), 300, 3000).alias("r")).collect()
    for row in found:
        cells = [(row.toxic, 300), (row.other, 3000), (300 - row.toxic, 300), (3000 - row.other, 3000)]
        n = row.toxic + row.other
        held = [n, n, 3300 - n, 3300 - n]
        expected = 2 * sum(o * math.log(o / (h * total / 3300)) for (o, total), h in zip(cells, held) if o)
        assert row.r == pytest.approx(expected, abs=1e-6)


def test_an_entry_is_listed_however_many_labels_there_are(spark):
    """Twelve toxic documents with a word of their own are enough among any number of others."""
    for toxic in (100, 20_000):
        rows = [("zorgle now" if i < 12 else f"bad w{i % 7}", 1) for i in range(toxic)]
        rows += [(f"calm w{i % 7}", 0) for i in range(10 * toxic)]
        labelled = spark.createDataFrame(rows, "text string, toxic int")
        entries = module._listed(Steps(spark), labelled).entries
        assert "zorgle" in entries and "bad" in entries and "calm" not in entries


def test_long_lists_are_joined(spark, given, odd_docs, monkeypatch):
    """With lists kept as a table, scores and verdicts are those of lists that tasks hold."""
    labels = given[1]
    docs = given[0].select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    docs = docs.selectExpr("doc_id", "text", "1 as h1", "2 as H2", "doc_id as score")
    expected = sorted(toxicity(docs, labels).collect(), key=repr)
    left = sorted(drop_toxic(docs, labels).collect(), key=repr)
    monkeypatch.setattr(module, "MOST_HELD", 5)
    found = sorted(toxicity(docs, labels).collect(), key=repr)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert (a.doc_id, a.held_out, a.predicted) == (b.doc_id, b.held_out, b.predicted)
        assert a.score == pytest.approx(b.score, abs=1e-6)
    assert sorted(drop_toxic(docs, labels).collect(), key=repr) == left and len(left) < len(found)
