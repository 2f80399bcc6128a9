import numpy as np
import pytest

from shelfweek.llm import neardup

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, copies int"


def usable(vector, label, vec_id):
    return (
        label is not None and vec_id is not None and bool(vector) and None not in vector
        and np.isfinite(vector).all() and any(vector)
    )


def brute(rows, threshold=0.98):
    """Per row (id, links, smallest id reachable) by comparing all pairs."""
    n = len(rows)
    near = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            (a, v, g, *_), (b, w, h, *_) = rows[i], rows[j]
            if usable(v, g, a) and usable(w, h, b) and g == h and len(v) == len(w):
                x, y = np.float32(v).astype(float), np.float32(w).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    near[i].add(j)
                    near[j].add(i)
    found = []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [rows[x][0] for x in reach]
        low = min(ids) if None not in ids else None
        found.append((rows[i][0], len(near[i]), low, rows[i][0] == low))
    return sorted(found, key=str)


def made(n=240, dim=16, seed=1):
    chance = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and i % 3:
            base = np.array(rows[chance.integers(len(rows))][1], float)
            vector = base * chance.uniform(0.2, 5) + chance.normal(0, 0.06, dim) * np.abs(base).max()
        else:
            vector = chance.normal(size=dim)
        rows.append((i, np.float32(vector).tolist(), int(chance.integers(3)) if i % 5 else 0, "x", 9))
    return rows


ODD = [
    (1000, None, 1, None, None), (1001, [], 1, None, None), (1002, [0.0] * 16, 1, None, None),
    (1003, [float("nan")] * 16, 1, None, None), (1004, [float("inf")] + [1.0] * 15, 1, None, None),
    (1005, [None] * 16, 1, None, None), (1006, [1.0] * 16, None, None, None), (1007, [1.0] * 16, 1, None, None),
    (1008, [1.0] * 15, 1, None, None), (1009, [2.0] * 16, 1, None, None), (1007, [1.0] * 16, 1, None, None),
    (None, [1.0] * 16, 1, None, None),
]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 20, "block": 8}])
def test_like_all_pairs(spark, options):
    rows = made() + ODD
    found = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA), **options)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(map(tuple, found.collect()), key=str)
    want = [(a, n, c, True if a is None else k) for a, n, c, k in brute(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimates_are_unbiased_and_bounded():
    chance = np.random.default_rng(3)
    x = neardup.unit(chance.normal(size=(4000, 32)))
    y = neardup.unit(x * 1.0 + chance.normal(0, 0.05, x.shape))
    codes, factors = neardup.encode(x)
    true = np.einsum("ij,ij->i", x, y)
    got = np.array([neardup.estimates(codes[[i]], factors[[i]], y[[i]])[0, 0] for i in range(len(x))])
    assert abs((got - true).mean()) < 0.005
    for threshold in (0.9, 0.95):
        linked = true >= threshold
        assert linked.any() and (got >= neardup.lowest_estimate(factors, threshold))[linked].all()


def test_extreme_lengths(spark):
    rows = [(1, [1e300, 0.0], 1), (2, [1e-300, 1e-302], 1), (3, [5.0, 0.01], 1), (4, [0.0, 2e300], 1)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = neardup.near_duplicates(vectors).collect()
    assert sorted(map(tuple, found)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


def test_copies_of_common_vectors_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT_COPIES", 20)
    rows = [(i, [1.0, 0.5] if i % 3 else [0.0, float(i)], 1, "x", 1) for i in range(120)]
    rows += [(500 + i, [1.0, 0.51], 1, "x", 1) for i in range(3)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    want = [(a, n, c, k) for a, n, c, k in brute(rows)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    valid = spark.createDataFrame([(i, 1, [1.0]) for i in range(50)], "id bigint, group int, vector array<double>")
    reps = spark.createDataFrame([(1, [1.0], 50, 49, 0)], "group int, vector array<double>, copies bigint, links bigint, component bigint")
    plan = neardup._joined_back(valid, reps)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_many_cells(spark):
    """More centres than a slice of vectors is wide; nothing is lost at the borders."""
    rows = made(900, 4)
    found = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA), cell_rows=2)
    want = [(a, n, c, k) for a, n, c, k in brute(rows)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
