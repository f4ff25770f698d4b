import random

import pytest

from lakemart.llm.common import Steps
from lakemart.llm.graph import components


def reference(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {node: root for node, root in label.items()}


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(500, i) for i in range(100)] + [(7, 600)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
    }[kind]
    edges += edges[:3]  # repeated
    found = components(spark.createDataFrame(edges, "a long, b long"), Steps(spark)).collect()
    expected = {n: r for n, r in reference(edges).items() if any(n in e and e[0] != e[1] for e in edges)}
    assert len(found) == len(expected) and dict(map(tuple, found)) == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Steps(spark)).collect() == []
