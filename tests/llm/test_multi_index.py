"""The inverted multi-index against brute force."""

import numpy as np
import pytest

from lakemart.llm.common import table
from lakemart.llm.multi_index import MultiIndex, nearest_by_multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, cell int, vector string, block long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, None, None, None) for i, v in rows], SCHEMA)


def brute(rows, k=20, every=20):
    rows = sorted(rows)
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for q in range(len(ids)):
        if ids[q] % every == 0:
            scores = (x * x[q]).sum(axis=1)
            others = np.flatnonzero(ids != ids[q])
            best = others[np.lexsort([ids[others], -scores[others]])][:k]
            out[int(ids[q])] = [(int(ids[b]), scores[b]) for b in best]
    return out


def found_of(df):
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert len(out[row.query_id]) == row.rank
    return out


def recall(found, expected):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in best}) / len(best) for q, best in expected.items()])


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_given_vectors(spark, folder):
    vectors = table(spark, f"/root/testdata/{folder}", "embeddings")
    rows = [(row.vec_id, row.embedding) for row in vectors.collect()]
    found, expected = found_of(nearest_by_multi_index(vectors)), brute(rows)
    assert set(found) == set(expected) and recall(found, expected) >= 0.9
    exact = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    for q, best in found.items():
        assert [s for _, s in best] == [float((exact[q] * exact[i]).sum()) for i, _ in best]
        assert best == sorted(best, key=lambda x: (-x[1], x[0])) and q not in {i for i, _ in best}


def test_clusters_need_few_candidates_and_are_found(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 8))
    rows = [(i, (centres[i % 30] + 0.05 * rng.normal(size=8)).tolist()) for i in range(1500)]
    assert recall(found_of(nearest_by_multi_index(frame(spark, rows))), brute(rows)) >= 0.9


def test_a_third_of_the_vectors_are_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 0.5, 1.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(1800)]
    found, expected = found_of(nearest_by_multi_index(frame(spark, rows))), brute(rows)
    assert recall(found, expected) >= 0.9
    assert found[0] == expected[0]  # equal scores go to smaller ids


def test_few_vectors_give_all_candidates(spark):
    rows = [(0, [1.0, 0.0, 1.0]), (20, [0.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (-20, [1.0, 1.0, 0.0])]
    assert found_of(nearest_by_multi_index(frame(spark, rows))) == brute(rows)
    assert found_of(nearest_by_multi_index(frame(spark, rows[:1]))) == {}
    assert found_of(nearest_by_multi_index(frame(spark, [(0, [2.0]), (1, [3.0])]))) == {0: [(1, 6.0)]}


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (40, [0.5, 0.5])]
    bad = [
        (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (8, [1.0]),
        (60, [-inf, 1.0]), (None, [1.0, 1.0]), (9, []),
    ]
    repeated = [(1, [2.0, 1.0]), (0, [1.0, 2.0]), (1, [2.5, 1.0])]
    df = nearest_by_multi_index(frame(spark, good + bad + repeated))
    assert found_of(df) == brute(good)


def test_no_vectors(spark):
    df = nearest_by_multi_index(frame(spark, []))
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.collect() == []


def test_the_walk_visits_cells_in_order():
    rng = np.random.default_rng(3)
    index = MultiIndex(rng.normal(size=(200, 6)), 7)
    query = rng.normal(size=6)
    cells = list(index.walk(query))
    sums = [(index.first[c // index.width] @ query[:3] + index.second[c % index.width] @ query[3:]) for c in cells]
    assert sorted(cells) == list(range(index.cells))
    assert all(a >= b - 1e-12 for a, b in zip(sums, sums[1:]))
