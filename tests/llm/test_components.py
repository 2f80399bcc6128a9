import random

import pytest

from shelfweek.llm.common import components


def smallest_reachable(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    chance = random.Random(seed)
    edges = [(chance.randrange(200), chance.randrange(200)) for _ in range(120)]
    edges += [(1000 + i, 1001 + i) for i in range(40)]  # a long path
    edges += [(5000, 5001 + i) for i in range(50)]  # a star
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert dict(found.collect()) == {
        x: low for x, low in smallest_reachable(edges).items()
        if any(x in e and e[0] != e[1] for e in edges)
    }


def test_no_edges_loops_and_nulls(spark):
    edges = spark.createDataFrame([(3, 3), (None, 4), (5, None)], "a bigint, b bigint")
    assert components(edges).collect() == []
    assert components(edges.limit(0)).collect() == []
