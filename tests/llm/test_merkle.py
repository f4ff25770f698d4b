"""The Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakemart.llm import merkle
from lakemart.llm.merkle import COLUMNS, fold, merkle_audit, merkle_proofs, without_line_feeds


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """All levels from the nodes to the last one."""
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([sha("".join(rows[-1][i : i + 3])) for i in range(0, len(rows[-1]), 3)])
    return rows


def path(rows, i):
    """Runs of a node, level by level, and its place in each."""
    for held in rows[:-1]:
        at = i // 3 * 3
        yield held[at : at + 3], i - at
        i //= 3


def brute(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    upper = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, node, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            runs = [*path(trees[s], i), *path(upper, k)]
            proof = sha("".join(x for run, at in runs for j, x in enumerate(run) if j != at))
            now = row
            if zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = (*row[:4], row[4].replace("\n", ""))
            folded = leaf(now)
            for run, at in runs:
                folded = sha("".join([*run[:at], folded, *run[at + 1 :]]))
            root = upper[-1][0]
            out.append((row[0], node, trees[s][-1][0], root, proof, folded, folded == root))
    return out


def audit(docs, **settings):
    rows = merkle_audit(docs, without_line_feeds(docs), **settings).collect()
    return [tuple(row) for row in rows]


def check(docs, **settings):
    rows = [tuple(row) for row in docs.select(*COLUMNS).collect()]
    assert sorted(map(repr, audit(docs, **settings))) == sorted(map(repr, brute(rows)))


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_given_documents(tiny_docs, levels):
    check(tiny_docs[0], levels=levels)


def test_odd_documents(odd_docs):
    check(odd_docs, levels=1)


def frame(spark, rows):
    schema = "text string, n_chars int, doc_id long, lang string, source string, position int, node string, key int, block string, owner string, part int, n string"
    full = [(text, None, doc_id, "é", source, *[None] * 7) for doc_id, source, text in rows]
    return spark.createDataFrame(full, schema)


@pytest.mark.parametrize("levels", [1, 2])
def test_sources_of_all_sizes(spark, levels):
    rng = random.Random(levels)
    sizes = [*range(1, 12), 27, 28, 82]
    sources = [None, "", "a", "é", "漢", "🎉", "-", "=", *[f"s{i}" for i in range(6)]]
    rows = [(rng.randrange(10**6), s, "x\ny\n" * (i % 3)) for s, n in zip(sources, sizes) for i in range(n)]
    rng.shuffle(rows)
    check(frame(spark, rows), levels=levels)


def test_many_sources_and_a_hot_one(spark):
    rows = [(i, f"s{i}" if i % 2 else "hot", "a\nb") for i in range(120)]
    check(frame(spark, rows), levels=2)


def test_small_sources_share_groups(spark):
    """A thousand sources of one or two documents make about as many groups as one source would."""
    rows = [(i, f"s{i % 700}", "a\nb" * (i % 3)) for i in range(1000)] + [(i, "hot", None) for i in range(60)]
    docs = frame(spark, rows)
    check(docs, levels=3)
    nodes = docs.selectExpr("source AS key", "doc_id AS position", "if(source = 'hot', 60, 2) AS n", "'' AS node")
    layer = merkle.Layer(nodes, 1000 // 27 + 1)
    groups = merkle._grouped(layer, ["key", "position", "n", "node"], 3).count().collect()
    small = [row["count"] for row in groups if row.block < 0]
    assert len(small) <= 38 and sum(small) == 1000


def test_repeated_rows_and_nulls(spark):
    rows = [(7, "a", "t\n")] * 5 + [(7, "a", "u"), (None, "a", None), (None, None, None), (None, None, "x\n")]
    check(frame(spark, rows), levels=1)


def test_one_document_and_none(spark, no_docs):
    check(frame(spark, [(1, "a", "b")]))
    assert audit(no_docs) == [] and merkle_proofs(no_docs).collect() == []


def test_proofs_fold_to_the_root_and_a_change_is_found(tiny_docs):
    rows = merkle_proofs(tiny_docs[0], levels=2).collect()
    assert len({row.root for row in rows}) == 1
    for row in rows:
        assert fold(row.leaf, row.before, row.after) == row.root
        assert fold(sha("other"), row.before, row.after) != row.root


def test_all_documents_are_verified_without_a_change(odd_docs):
    assert all(row.verified for row in merkle_audit(odd_docs).collect())
