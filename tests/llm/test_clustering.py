import hashlib

import numpy as np
import pytest

from shelfweek.llm import clustering

SCHEMA = "vec_id bigint, embedding array<double>, label int, cluster int, distance double"


def brute(rows, clusters, rounds, dim):
    """Lloyd's rounds with Python's own integers: rows (id, cluster, distance, inertia of it, of all, centroid)."""
    limit = clustering.largest_component(dim)
    kept = [
        (i, [int(np.clip(np.floor(np.clip(256 * x, -limit, limit)), -limit, limit)) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == dim and None not in v and np.isfinite(v).all()
    ]

    def rank(row):
        i, v = row
        return (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v)

    centroids = [v for _, v in sorted(kept, key=rank)[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            square = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((min(square), square.index(min(square))))
        return out

    for _ in range(rounds):
        own = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    most = (1 << 63) - 1
    inertia = [min(most, sum(d for d, c in own if c == k)) for k in range(len(centroids))]
    every = min(most, sum(d for d, _ in own))
    return sorted(
        ((i, c, d, inertia[c], every, centroids[c]) for (i, _), (d, c) in zip(kept, own)), key=str
    )


def found(spark, rows, **options):
    got = clustering.cluster(spark.createDataFrame(rows, SCHEMA), **options)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def rows_of(n, dim, seed=0, spread=1.0):
    chance = np.random.default_rng(seed)
    middles = chance.normal(size=(6, dim)) * 2
    return [
        (i, (middles[chance.integers(6)] + spread * chance.normal(size=dim)).tolist(), 1, 9, 0.5)
        for i in range(n)
    ]


@pytest.mark.parametrize("clusters, rounds", [(1, 2), (7, 0), (7, 1), (12, 5), (40, 8)])
def test_like_plain_rounds(spark, clusters, rounds):
    rows = rows_of(300, 8, clusters)
    got = found(spark, rows, clusters=clusters, rounds=rounds, dim=8)
    assert got == brute(rows, clusters, rounds, 8)


def test_odd_rows(spark):
    rows = rows_of(60, 4) + [
        (1, None, 1, None, None), (2, [1.0, 2.0, 3.0], 1, None, None), (3, [1.0, None, 3.0, 4.0], 1, 1, 1.0),
        (4, [float("nan")] * 4, 1, 1, 1.0), (5, [float("-inf")] * 4, 1, 1, 1.0), (6, [], 1, 1, 1.0),
        (None, [0.5, 0.5, 0.5, 0.5], None, None, None), (None, [0.5, 0.5, 0.5, 0.5], None, None, None),
        (7, [0.0] * 4, 1, 1, 1.0), (7, [0.0] * 4, 1, 1, 1.0), (8, [1e300, -1e300, 1e30, 0.0], 1, 1, 1.0),
        (8, [-1e300, 1e300, 1e30, 0.0], 1, 1, 1.0),
    ]
    got = found(spark, rows, clusters=5, dim=4)
    assert got == brute(rows, 5, 5, 4) and len(got) == 66


def test_copies_and_few_rows(spark):
    rows = [(i, [1.0, -1.0], 1, 1, 1.0) for i in range(200)] + [(500 + i, [3.0, i / 4], 1, 1, 1.0) for i in range(9)]
    assert found(spark, rows, clusters=20, dim=2) == brute(rows, 20, 5, 2)
    assert found(spark, rows[:3], clusters=20, dim=2) == brute(rows[:3], 20, 5, 2)
    assert found(spark, [], dim=2) == []
    assert found(spark, [(1, None, 1, 1, 1.0)], dim=2) == []


def moving(n, dim, clusters, rounds, seed):
    """Vectors, and the centroids of some rounds."""
    chance = np.random.default_rng(seed)
    vectors = np.floor(256 * chance.normal(size=(n, dim)) + 512 * chance.normal(size=(6, dim))[chance.integers(6, size=n)])
    vectors = vectors.astype(np.int64)
    history = [vectors[:clusters]]
    for _ in range(rounds):
        own = ((vectors[:, None] - history[-1]) ** 2).sum(2).argmin(1)
        means = [vectors[own == k].sum(0) // (own == k).sum() if (own == k).any() else history[-1][k] for k in range(clusters)]
        history.append(np.array(means))
    return vectors, np.array(history)


def test_bounds_hold_and_save_distances():
    vectors, history = moving(2000, 16, 20, 12, 3)
    bounds, evaluated = clustering.Bounds.first(vectors, history[0]), 0
    for r in range(1, len(history)):
        evaluated += bounds.moved(vectors, history[: r + 1])
        square = ((vectors[:, None] - history[r]) ** 2).sum(2)
        assert (bounds.cluster == square.argmin(1)).all()
        shift = np.sqrt(((history[: r + 1] - history[r]) ** 2).sum(2))
        low = bounds.lower - shift[bounds.seen, np.arange(20)]
        assert (low <= np.sqrt(square) + 1e-6).all()
    assert evaluated < 0.5 * 12 * square.size


def test_loosened_by_the_total_displacement_not_the_sum_of_drifts():
    """A centroid that goes away and comes back leaves the bounds as they were."""
    vectors = np.array([[0, 0], [1, 0]])
    here, there = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [140, 0]])
    bounds = clustering.Bounds.first(vectors, here)
    assert bounds.moved(vectors, np.array([here, there, here])) == 0
    assert bounds.moved(vectors, np.array([here, there, here, there, here, here])) == 0


def test_exact_beyond_doubles():
    top = clustering.largest_component(3)
    vectors = np.array([[top, -top, top], [top - 1, -top, top]])
    centroids = np.array([[-top, top, -top], [top, -top, top - 1]])
    want = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids.tolist()] for v in vectors.tolist()]
    assert clustering.squared(vectors, centroids).tolist() == want
