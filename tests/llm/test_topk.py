import math

import numpy as np
import pytest

from shelfweek.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, norm double, band int"
ASKS = "vec_id % 10 = 0"


def brute(rows, k=10, asks=lambda i: i % 10 == 0):
    seen = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            seen[i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)] = True
    found = []
    for i, v in seen:
        if asks(i):
            scores = sorted(
                (-sum(a * b for a, b in zip(v, w)), j) for j, w in seen if j != i and len(v) == len(w)
            )
            found += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(found)


def rows_of(n, seed=0, spread=1.0):
    chance = np.random.default_rng(seed)
    return [
        (i, (chance.normal(size=12) * chance.lognormal(0, spread)).astype(np.float32).tolist(), 1, 0.0, 1)
        for i in range(n)
    ]


ODD = [
    (700, None, 1, None, 1), (710, [None] * 12, 1, None, 1), (720, [float("nan")] * 12, 1, None, 1),
    (730, [float("inf")] * 12, 1, None, 1), (None, [1.0] * 12, 1, None, 1), (740, [1.0] * 5, 1, None, 1),
    (751, [-1.0] * 5, 1, None, 1), (3, [0.5] * 12, 1, None, 1), (3, [0.5] * 12, 1, None, 1),
    (760, [], 1, None, 1), (761, [], 1, None, 1),
]


@pytest.mark.parametrize("block", [8192, 16])
def test_like_all_scores(spark, block):
    rows = rows_of(150) + ODD
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), ASKS, block=block)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0], 1, 0.0, 1) for i in range(40)]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), ASKS, block=4).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_numbers_beyond_doubles(spark):
    rows = [(i, [2.0**20 + i, -(2.0**20), 3.0], 1, 0.0, 1) for i in range(30)]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), ASKS, block=8).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_vectors_are_copied_to_the_queries_that_reach_them(spark, monkeypatch):
    """Short vectors that no query reaches are not copied, however many queries there are."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    chance = np.random.default_rng(3)
    long = [(i, (100 * chance.normal(size=6)).tolist(), 1, 0.0, 1) for i in range(200)]
    short = [(1001 + 10 * i, (0.01 * chance.normal(size=6)).tolist(), 1, 0.0, 1) for i in range(600)]
    given = []
    block_top = topk._block_top

    def counting(*args):
        work = block_top(*args)
        seen = spark.sparkContext.accumulator(0)
        given.append(seen)

        def top(key, rows):
            seen.add(int((~rows["asks"]).sum()))
            return work(key, rows)

        return top

    monkeypatch.setattr(topk, "_block_top", counting)
    frame = spark.createDataFrame(long + short, SCHEMA)
    found = topk.top_k(frame, ASKS, block=50).collect()
    assert sorted(map(tuple, found)) == brute(long + short)
    # Every part of the queries meets the longest block; of the rest only what some query reaches.
    assert given[1].value < 6 * 200


def test_few_rows(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), ASKS).collect() == []
    two = spark.createDataFrame([(0, [1.0], 1, 0.0, 1), (1, [2.0], 1, 0.0, 1)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(two, ASKS).collect()] == [(0, 1, 1, 1024 * 2048)]
