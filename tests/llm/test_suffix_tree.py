"""Suffix-tree scores: base scores by brute force, normalised states, held-out likelihood."""

import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from lakemart.llm import suffix_tree
from lakemart.llm.common import Steps
from lakemart.llm.suffix_tree import suffix_tree_scores

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def base_rows(rows):
    tokens = [(i, [*(text or "").encode().translate(LOWER).split(), None]) for i, text in rows]
    counts = Counter(w for i, words in tokens if not held_out(i) for w in words)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, held_out(i), len(words), sum(counts[w] > 0 for w in words), n,
         sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in words))
        for i, words in tokens
    ]


def check(docs, **settings):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    found = suffix_tree_scores(docs, **settings).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[2], row[5])
    for got, expected in zip(sorted(map(tuple, found), key=key), sorted(base_rows(rows), key=key), strict=True):
        assert got[:5] == expected[:5]
        assert got[5] == pytest.approx(expected[5], rel=1e-9)
        assert got[6] <= 1e-9
    return found


def test_given_documents(tiny_docs):
    found = check(tiny_docs[0])
    held = [row for row in found if row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_no_documents(no_docs):
    assert suffix_tree_scores(no_docs).collect() == []


def test_only_held_out_documents(make_docs):
    ids = [i for i in range(100) if held_out(i)][:3]
    found = suffix_tree_scores(make_docs(*[(i, "some words") for i in ids])).collect()
    assert [(row.train_tokens, row.base_score, row.score, row.n_known) for row in found] == [(0, 0, 0, 0)] * 3


class Tree:
    """The tree in plain Python: counts by context, states, smoothed probabilities."""

    def __init__(self, texts, least_count, least_gain, discount):
        self.discount = discount
        self.next = defaultdict(Counter)
        for words in texts:
            for i, word in enumerate(words):
                for k in range(min(i, 3) + 1):
                    self.next[tuple(words[i - k : i])][word] += 1
        self.total = {context: held.total() for context, held in self.next.items()}
        self.states = set()
        for context, held in self.next.items():
            if context and self.total[context] >= least_count:
                suffix = context[1:]
                gain = sum(
                    round(256 * n * math.log(n / self.total[context] / (self.next[suffix][w] / self.total[suffix])))
                    for w, n in held.items()
                )
                if gain >= 256 * (least_gain + len(held)):
                    self.states.add(context)

    def p(self, context, word):
        if not context:
            return (self.next[()][word] + 1) / (self.total[()] + len(self.next[()]) + 1)
        held, total = self.next[context], self.total[context]
        own = max(held[word] - self.discount, 0) / total
        return own + self.discount * len(held) / total * self.p(context[1:], word)

    def score(self, words):
        out = 0
        for i, word in enumerate(words):
            contexts = [tuple(words[i - k : i]) for k in range(min(i, 3), 0, -1)]
            out += math.log10(self.p(next((c for c in contexts if c in self.states), ()), word))
        return out


def compare(docs, least_count=4, least_gain=5.0, discount=0.75):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    texts = [[*(text or "").encode().translate(LOWER).split(), None] for _, text in rows]
    settings = {"least_count": least_count, "least_gain": least_gain, "discount": discount}
    tree = Tree([t for t, (i, _) in zip(texts, rows) if not held_out(i)], **settings)
    expected = sorted((i is None, i or 0, tree.score(t)) for t, (i, _) in zip(texts, rows))
    found = check(docs, **settings)
    got = sorted((row.doc_id is None, row.doc_id or 0, row.score) for row in found)
    for a, b in zip(got, expected, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)
    return tree, found


def test_scores_equal_a_plain_tree(tiny_docs, monkeypatch):
    """With one part and range, and with many small ones."""
    docs = tiny_docs[0]
    tree, _ = compare(docs)
    assert {len(c) for c in tree.states} == {1, 2, 3}
    monkeypatch.setattr(suffix_tree, "RANGE_TOKENS", 1 << 12)
    compare(docs.repartition(5), least_count=2, least_gain=1.5, discount=0.5)


def test_small_parts(monkeypatch, tiny_docs, spark):
    """Parts cut within a task give what one part gives."""
    batches = [pa.record_batch({
        "doc_id": pa.array([1, 2, None]), "text": pa.array(["a b", "", "b b c"]), "held_out": pa.array([False, True, False]),
    })]
    monkeypatch.setattr(suffix_tree, "PART_BYTES", 8)
    monkeypatch.setattr(suffix_tree.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 3})())
    rows = [row for batch in suffix_tree._code(iter(batches)) for row in batch.to_pylist()]
    assert len(rows) > 1 and len({row["part"] for row in rows}) == len(rows)
    assert [i for row in rows for i in row["doc_ids"]] == [1, 2, None]


def test_states_are_distributions_and_follow_the_longest_suffix(make_docs):
    """Text with a memory of two words: the tree learns it, and every context sums to one."""
    rows = [(i, "a b c a d e " * 30 + f"rare{i}") for i in range(60)]
    tree, found = compare(make_docs(*rows))
    words = list(tree.next[()])
    for context in tree.states:
        total = sum(tree.p(context, w) for w in words)
        unseen = 1 / (tree.total[()] + len(words) + 1)
        for k in range(len(context)):
            suffix = context[k:]
            unseen *= tree.discount * len(tree.next[suffix]) / tree.total[suffix]
        assert total + unseen == pytest.approx(1)
    # after "c a" comes d, after "e a" b: one word doesn't tell, two do
    assert tree.p((b"c", b"a"), b"d") > 0.9 > tree.p((b"a",), b"d") and (b"c", b"a") in tree.states
    assert all(row.score > row.base_score for row in found)


def test_more_text_gives_more_contexts(make_docs):
    """The least count is absolute: what is learned of a text doesn't wane as others come."""
    rng = random.Random(1)
    ids = [i for i in range(3000) if not held_out(i)]
    held = next(i for i in range(3000) if held_out(i))
    song = "north wind over cold harbour lights went out"
    texts = [(i, song) for i in ids[:8]] + [(held, song)]
    noise = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(60))) for i in ids[8:1500]]
    alone, among = (
        next(row for row in suffix_tree_scores(make_docs(*rows)).collect() if row.doc_id == held)
        for rows in (texts, texts + noise)
    )
    assert among.train_tokens > 100 * alone.train_tokens
    # but for the first word, each is foretold by those before it
    assert among.score - among.base_score > 20 and among.score > -6


def test_blocks_of_numbers():
    rng = np.random.default_rng(1)
    for values in ([], [0], [0, 0], [255, 256], rng.integers(0, 2**56, 1000), [2**64 - 1, 0]):
        values = np.array(values, dtype=np.uint64)
        assert suffix_tree.unpacked(suffix_tree.packed(values)).tolist() == values.tolist()
    signed = np.array([0, -1, 5, -(2**40), 2**40], dtype=np.int64)
    assert suffix_tree._unsigned(suffix_tree._signed(signed)).tolist() == signed.tolist()


def test_the_table_of_parts_is_not_moved_again(spark, tiny_docs):
    """Joining by part and grouping by it need no exchange; steps that are dropped are gone."""
    steps = Steps(spark)
    texts = tiny_docs[0].selectExpr("doc_id", "text", "false AS held_out").repartition(3)
    parts = steps.keep_by(texts.mapInArrow(suffix_tree._code, suffix_tree._PART), "part", 8)
    answers = steps.keep_by(parts.selectExpr("part", "training AS answer"), "part", 8)
    both = parts.join(answers.hint("merge"), "part")
    found = both.groupBy("part").applyInArrow(lambda table: table, both.schema)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    kept, names = steps.keep(found.select("part", "answer")), list(steps.tables)
    paths = [Path(path) for path, _ in steps.kept]
    assert all(path.exists() for path in paths)
    steps.drop_all_but(kept)
    assert kept.count() == 3 and not any(spark.catalog.tableExists(name) for name in names)
    assert [path.exists() for path in paths] == [False, False, True]


def test_pairs_of_numbers_have_keys_of_their_own():
    a, b = (x.ravel().astype(np.uint64) for x in np.meshgrid(np.arange(128), np.arange(128)))
    keys = suffix_tree.paired(a, b, 7)
    assert sorted(keys.tolist()) == list(range(1 << 14))
    # those of one frequent word go to all ranges
    assert len(set((suffix_tree.paired(a[:1] + b, b, 10) >> np.uint64(16)).tolist())) == 16
    wide = np.array([0, 1, 2**32 - 1], dtype=np.uint64)
    assert len(set(suffix_tree.paired(wide, wide[::-1], 32).tolist())) == 3


def test_what_one_part_has_is_not_asked_for_again(monkeypatch):
    """Both parts have "a b c" often, only the first has the words after it."""
    monkeypatch.setattr(suffix_tree.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    rows = []
    for number, text in enumerate(["a b c d e f g h " * 6, "a b c " * 6]):
        docs = {"doc_id": pa.array([number]), "text": pa.array([text]), "held_out": pa.array([False])}
        (batch,) = suffix_tree._code(iter([pa.record_batch(docs)]))
        rows.append(batch.to_pylist()[0] | {"part": number})
    settings = suffix_tree.Settings(4, 5.0, 0.75, 0, 40, sum(row["training"] for row in rows))
    asked = pa.concat_tables([suffix_tree._ask_words(settings)(pa.Table.from_pylist([row])) for row in rows])
    found = suffix_tree._add_words(asked).to_pylist()
    settings.distinct, settings.word_bits = 9, 4
    parts = []
    for row in rows:
        row["numbers"] = [x for x in found if x["part"] == row["part"]]
        parts += suffix_tree._number(0)(pa.Table.from_pylist([row])).to_pylist()
    sent = {}
    for number in range(1, suffix_tree.ROUNDS + 1):
        tables = [suffix_tree._round(settings, number)(pa.Table.from_pylist([row])) for row in parts]
        for row, table in zip(parts, tables):
            for x in table.to_pylist():
                sent[row["part"], x["kind"]] = len(suffix_tree.unpacked(x["keys"]))
        whole = pa.concat_tables(tables)
        answers = []
        for kind in set(whole.column("kind").to_pylist()):
            of_kind = whole.filter(pa.array([k == kind for k in whole.column("kind").to_pylist()]))
            answers += suffix_tree._range(settings.least_gain)(of_kind).to_pylist()
        for row in parts:
            row[f"answers{number}"] = [x for x in answers if x["part"] == row["part"]]
    # of all triples only "a b c" has no pair of one part alone; no quad is in both parts
    assert (sent[0, suffix_tree.PAIRS], sent[1, suffix_tree.PAIRS]) == (9, 4)
    assert sent[0, suffix_tree.TRIPLES] == sent[1, suffix_tree.TRIPLES] == 1
    assert not {(0, suffix_tree.QUADS), (1, suffix_tree.QUADS)} & {*sent}


def test_a_step_is_dropped_by_itself(spark):
    steps = Steps(spark)
    first, second = steps.keep(spark.range(3)), steps.keep(spark.range(4))
    (gone, _), (held, _) = steps.kept
    steps.drop(first)
    assert not Path(gone).exists() and Path(held).exists() and second.count() == 4
    assert [path for path, _ in steps.kept] == [held]
