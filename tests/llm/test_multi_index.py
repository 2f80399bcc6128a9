import duckdb
import numpy as np
import pytest

from shelfweek.llm import multi_index
from shelfweek.llm.queries import OP11_SQL

SCHEMA = "vec_id bigint, embedding array<double>, label int, cell bigint, block int, q bigint"
ASKS = "vec_id % 10 = 0"
MORE = (1, 2, 3, 4)


def brute(rows, k=10, asks=lambda i: i % 10 == 0):
    """Every row but the query's own, by distance and id."""
    usable = [
        (n, i, v) for n, (i, v, *_) in enumerate(rows)
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    found = []
    for n, i, v in usable:
        if asks(i):
            near = sorted(
                (float(multi_index.exact(np.array([v]), np.array([w]))[0]), j)
                for m, j, w in usable if m != n and len(w) == len(v)
            )
            found += [(i, r, j, s) for r, (s, j) in enumerate(near[:k], 1)]
    return sorted(found)


def rows_of(n, dim=12, seed=0, centres=20):
    chance = np.random.default_rng(seed)
    middles = 3 * chance.normal(size=(centres, dim))
    return [(i, (middles[chance.integers(centres)] + chance.normal(size=dim)).tolist(), *MORE) for i in range(n)]


def found(spark, rows, **options):
    got = multi_index.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), ASKS, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


ODD = [
    (700, None, *MORE), (710, [None] * 12, *MORE), (720, [float("nan")] * 12, *MORE), (730, [0.0] * 12, *MORE),
    (740, [float("inf")] * 12, *MORE), (None, [1.0] * 12, *MORE), (750, [1.0] * 5, *MORE), (761, [-1.0] * 5, *MORE),
    (770, [], *MORE), (3, [0.5] * 12, *MORE), (3, [0.5] * 12, *MORE), (10, [0.25] * 12, None, None, None, None),
    (10, [0.25] * 12, None, None, None, None), (20, [1e200] * 12, *MORE), (21, [-1e200] * 12, *MORE), (780, [2.0], *MORE),
]


@pytest.mark.parametrize("block", [8192, 16])
def test_small_tables_are_searched_whole(spark, block):
    rows = rows_of(200) + ODD
    assert found(spark, rows, block=block) == brute(rows)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 0.0], *MORE) for i in range(60)] + [(100 + i, [0.0, 1.0], *MORE) for i in range(5)]
    rows += [(100, [0.0, 1.0], *MORE)]
    assert found(spark, rows, block=1) == brute(rows)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], *MORE)]) == []
    assert found(spark, [(0, [1.0], *MORE), (1, [4.0], *MORE)]) == [(0, 1, 1, 3.0)]


def test_walk_takes_every_pair_in_order():
    chance = np.random.default_rng(2)
    for a, b in ((1, 1), (1, 7), (6, 1), (9, 11)):
        for first, second in ((chance.random(a), chance.random(b)), (np.ones(a), np.ones(b))):
            cells = list(multi_index.walk(first, second))
            assert sorted(cells) == list(range(a * b))
            sums = (first[:, None] + second).ravel()[cells]
            assert (np.diff(sums) >= 0).all()


def recall(got, want):
    by_query = lambda rows: {q: {v for p, _, v, _ in rows if p == q} for q in {r[0] for r in rows}}
    have, true = by_query(got), by_query(want)
    return sum(len(have[q] & true[q]) for q in true) / sum(map(len, true.values()))


@pytest.mark.parametrize("centres", [25, 4000])
def test_recall_of_partial_walks(spark, centres):
    """Beyond ``least`` the search is not whole: clustered and even vectors keep the recall."""
    rows = rows_of(4000, centres=centres)
    got = found(spark, rows, least=50, block=256)
    want = brute(rows)
    assert recall(got, want) >= 0.9
    exact = {(q, v): s for q, _, v, s in want}
    assert all(exact[q, v] == s for q, _, v, s in got if (q, v) in exact)


def test_walks_pass_a_part_of_clustered_vectors(spark):
    rows = np.array([r[1] for r in rows_of(6000, centres=40)])
    books = multi_index.Codebooks(rows[:2000], len(rows))
    cells = books.cells(rows)
    number = np.bincount(cells, minlength=books.size**2)
    near = []
    for q in range(40):
        square = ((rows - rows[q]) ** 2).sum(1)
        near.append(cells[np.argsort(square)[1:11]].tolist())
    length = multi_index.walk_length(rows[:40], near, books, number)
    assert 10 <= length < 2000


def test_whole_table_against_sql(spark):
    """Recall on the embeddings of sf0.1, and scores as SQL computes them."""
    path = "/root/testdata/sf0.1/embeddings.parquet"
    got = multi_index.nearest_neighbours(spark.read.parquet(path), "vec_id % 100 = 0", least=100)
    got = sorted(map(tuple, got.collect()))
    want = duckdb.connect().execute(f"WITH embeddings AS (FROM '{path}') " + OP11_SQL.replace("WITH usable", ", usable", 1)).fetchall()
    assert recall(got, want) >= 0.9
    scores = {(q, v): s for q, _, v, s in want}
    assert all(scores[q, v] == s for q, _, v, s in got if (q, v) in scores)
