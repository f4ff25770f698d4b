"""The n-gram Jaccard join against all pairs."""

import random
from collections import Counter
from itertools import combinations

import pytest
from llm_texts import prose

from lakemart.llm import ngram_jaccard
from lakemart.llm.ngram_jaccard import bands_for, ngram_jaccard_join

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def ngrams(text, n=5):
    words = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def all_pairs(rows, threshold=0.8):
    """For each row: class id, copies, links to other texts, links to documents."""
    sets = [ngrams(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    documents, texts, copies = Counter(), Counter(), Counter()
    by_set = Counter(s for s in sets if s)
    seen = {}
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) >= threshold * len(a | b):
            documents.update([i, j])
            parent[max(root(i), root(j))] = min(root(i), root(j))
    for s in by_set:
        seen[s] = sum(s != t and len(s & t) >= threshold * len(s | t) for t in by_set)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [
        (least.get(root(i)), by_set.get(s, 1), seen.get(s, 0), documents[i])
        for i, s in enumerate(sets)
    ]


def check(docs, **settings):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    expected = Counter(zip((doc_id for doc_id, _ in rows), all_pairs(rows)))
    found = Counter(
        (row.doc_id, (row.class_id if row.class_id >= 0 or row.doc_id is not None else None, *tuple(row)[2:]))
        for row in ngram_jaccard_join(docs, **settings).collect()
    )
    assert found == expected


def test_given_documents(tiny_docs):
    check(tiny_docs[0])


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_no_documents(no_docs):
    assert ngram_jaccard_join(no_docs).collect() == []


@pytest.mark.parametrize("block", [2, 5, 256])
def test_a_large_group_in_blocks(make_docs, block):
    """Near copies of one text, many of them, some beyond the threshold of others."""
    rng = random.Random(block)
    base = prose(120, 7).split()
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice([0, 1, 1, 2, 3, 5])):
            words[at] = f"changed{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, prose(120, 7)) for i in range(30)]
    check(make_docs(*rows), block=block)


def test_a_long_chain(spark, make_docs, monkeypatch):
    """Twenty thousand texts, each like its neighbours only: sets don't meet the whole group."""
    n, seen, inner = 20_000, [], ngram_jaccard._places

    def counted(*args):
        places = inner(*args)
        seen.append(places.selectExpr("sum(size(places)) AS sent").first()["sent"])
        return places

    monkeypatch.setattr(ngram_jaccard, "_places", counted)
    docs = spark.range(n).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(8 * id, 8 * id + 103), x -> concat('w', x))) AS text"
    )
    found = {row.doc_id: row for row in ngram_jaccard_join(docs).collect()}
    # 92 of 108 n-grams in common with the next text, 84 of 116 with the one after that
    assert len(found) == n and all(row.class_id == 0 for row in found.values())
    assert all(row.n_links == row.n_text_links == (1 if i in (0, n - 1) else 2) for i, row in found.items())
    (sent,) = seen
    # plausible are at most some texts on each side; all blocks would make 80 for each text
    assert sent <= 10 * n


def test_rows_without_an_id(make_docs):
    """Half of the rows have no id, and many of them one text."""
    rng, rows = random.Random(3), []
    for i in range(40):
        words = prose(80, i).split()
        rows += [(i, " ".join(words)), (None, " ".join(words[:-1] + ["end"])), (None, " ".join(words))]
    rows += [(None, prose(60, 50))] * 30 + [(7, prose(60, 50))] * 3
    rng.shuffle(rows)
    check(make_docs(*rows))


def test_the_plan_fetches_by_row_key(make_docs):
    """Of rows with one id and text one in each chunk is fetched."""
    import numpy as np
    import pyarrow as pa

    rows = pa.record_batch({
        "doc_id": pa.array([None, None, 0, 1, 1, None], pa.int64()), "text": pa.array(list("aabcca")),
        "t1": pa.array([5, 5, 5, 7, 7, 5]), "t2": pa.array([1, 1, 1, 3, 3, 1]),
    })
    (out,) = ngram_jaccard._once(iter([rows]))
    assert out.column("text").to_pylist() == ["a", "b", "c"] and out.column("doc_id").to_pylist() == [None, 0, 1]
    assert np.array_equal(out.column("t1").to_numpy(), [5, 5, 7])


def test_a_pair_at_the_threshold(make_docs):
    """8 of 10 n-grams in common is enough, 8 of 11 is not."""
    words = [f"w{i}" for i in range(20)]
    first = " ".join(words[:13])  # 9 n-grams
    check(make_docs((1, first), (2, " ".join(words[:14])), (3, " ".join(words[1:13])), (4, first.upper())))


def test_bands_reach_the_target_recall():
    for rows in (2, 4, 6):
        bands = bands_for(0.8, rows, 0.9999)
        assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
        assert 1 - (1 - 0.8**rows) ** (bands - 1) < 0.9999


def test_no_pairs_leave_a_task(make_docs):
    """Rows grow with the members of a group, not with their square."""
    import numpy as np
    import pyarrow as pa

    n = 200
    sets = [np.arange(50, dtype=np.uint64) + np.uint64(i % 3) for i in range(n)]
    batch = pa.record_batch(
        {
            "component": pa.array([1] * n), "bi": pa.array([0] * n, pa.int32()),
            "bj": pa.array([0] * n, pa.int32()), "side": pa.array([0] * n, pa.int32()),
            "node": pa.array(range(n)), "copies": pa.array([1] * n),
            "grams": pa.array([s.tobytes() for s in sets], pa.binary()),
        }
    )
    (out,) = ngram_jaccard._verified(0.8)(iter([batch]))
    assert out.num_rows == n and out.column("documents").to_pylist() == [n - 1] * n
