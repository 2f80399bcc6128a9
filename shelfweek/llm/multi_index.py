"""Approximate nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised separately, each with its own
codebook, and a vector is an entry of the cell of its pair of centroids. A query
walks through the pairs in ascending order of its summed distances to the two
centroids, with a heap, until the cells it has passed hold enough entries; their
vectors are then compared exactly, in double precision.

How many entries are enough is measured: for a bounded sample of the queries the
true neighbours are found by brute force over all vectors, and the walk is made
as long as it takes to meet the wanted share of them. Codebooks are fitted on a
bounded sample as well; every vector is indexed.

Cells are laid end to end and cut into blocks of equal size, so a cell of many
entries lies in several and a block holds many small cells. A query visits a
block once, with the list of the cells it wants there.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.llm.common import checkpoint, condition, few, sampled

# Vectors that the codebooks are fitted on, rounds of the fit, entries aimed at per cell.
SAMPLE = 16_384
FIT_ROUNDS = 10
CELL_ROWS = 16
MAX_CENTROIDS = 256
# Queries whose true neighbours are found, and the share of these that the walk is to meet.
MEASURED = 128
RECALL = 0.95
# Entries that a walk passes at least.
LEAST = 1024
# Entries of a block, queries that meet one at a time.
BLOCK = 1024
QUERY_BLOCK = 512
# Components that only choose a cell are cut to this, so that squares fit a double.
FAR = 1e150


def fitted(points: np.ndarray, k: int) -> np.ndarray:
    """At most k centroids of the points by Lloyd's rounds; deterministic."""
    order = np.random.default_rng(k).permutation(len(points))[:k]
    centroids = points[order].copy()
    for _ in range(FIT_ROUNDS):
        own = distances(points, centroids).argmin(axis=1)
        number = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        held = number > 0
        centroids[held] = sums[held] / number[held, None]
    return centroids


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, within rounding."""
    square = np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right)
    return np.maximum(square - 2 * (left @ right.T), 0.0)


class Codebooks:
    """The centroids of both halves; vectors of another length have a cell to themselves."""

    def __init__(self, sample: np.ndarray, total: int):
        self.dim = sample.shape[1]
        self.half = self.dim // 2
        k = int(np.clip(round((total / CELL_ROWS) ** 0.5), 1, MAX_CENTROIDS))
        sample = np.clip(sample, -FAR, FAR)
        self.books = [fitted(part, k) for part in (sample[:, : self.half], sample[:, self.half :])]
        self.size = len(self.books[0])

    def halves(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Squared distances to the centroids of either half."""
        cut = np.clip(vectors, -FAR, FAR)
        parts = cut[:, : self.half], cut[:, self.half :]
        return [distances(part, book) for part, book in zip(parts, self.books)]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector; minus its length where that is not the codebooks'."""
        if vectors.shape[1] != self.dim:
            return np.full(len(vectors), -vectors.shape[1], np.int64)
        first, second = (part.argmin(axis=1) for part in self.halves(vectors))
        return first * self.size + second


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[int]:
    """Cells by ascending sum of the distances to their two centroids.

    A pair is put on the heap when both pairs before it have been taken.
    """
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap, taken = [(x[0] + y[0], 0, 0)], [0] * len(x)
    while heap:
        _, i, j = heapq.heappop(heap)
        yield a[i] * len(y) + b[j]
        taken[i] = j + 1
        if i + 1 < len(x) and taken[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < len(y) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances row by row, squares added from the first component on."""
    top = max(np.abs(left).max(initial=0.0), np.abs(right).max(initial=0.0))
    scale = 2.0 ** np.floor(np.log2(top)) if top > FAR or 0 < top < 1 / FAR else 1.0
    difference = left / scale - right / scale
    if not difference.shape[1]:
        return np.zeros(len(difference))
    return np.sqrt(np.add.accumulate(difference * difference, axis=1)[:, -1]) * scale


def _stacked(vectors) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _placed(books: Codebooks):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, part in rows.groupby("dim"):
                yield part.assign(cell=books.cells(_stacked(part["vector"])))

    return place


def _true_neighbours(asked: list, k: int):
    """For each of the few asked vectors the k nearest others of a task, with their cells."""
    queries = np.clip(np.array(asked, np.float64), -FAR, FAR)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"q": [], "cell": [], "square": []})
        for rows in batches:
            rows = rows[rows["dim"] == queries.shape[1]]
            if not len(rows):
                continue
            square = distances(np.clip(_stacked(rows["vector"]), -FAR, FAR), queries)
            # A query's own vector is no neighbour; rounding keeps it near zero.
            square[square <= 1e-12 * np.einsum("ij,ij->i", queries, queries)] = np.inf
            near = np.argsort(square, axis=0, kind="stable")[:k]
            found = pd.DataFrame({
                "q": np.broadcast_to(np.arange(len(queries)), near.shape).ravel(),
                "cell": rows["cell"].to_numpy()[near].ravel(),
                "square": np.take_along_axis(square, near, axis=0).ravel(),
            })
            best = pd.concat([best, found]).sort_values(["q", "square"]).groupby("q").head(k)
        yield best.astype({"q": "int32", "cell": "int64"})

    return nearest


def walk_length(queries: np.ndarray, neighbours: list[list[int]], books: Codebooks, number: np.ndarray) -> int:
    """Entries to pass so that RECALL of the neighbours (their cells, per query) are met."""
    needed = []
    for first, second, cells in zip(*books.halves(queries), neighbours):
        wanted, passed = {c: cells.count(c) for c in cells}, 0
        for cell in walk(first, second):
            passed += int(number[cell])
            needed += [passed] * wanted.pop(cell, 0)
            if not wanted:
                break
    return int(np.quantile(needed, RECALL, method="higher")) if needed else 0


def _visits(books: Codebooks, number: np.ndarray, offset: np.ndarray, others: dict, length: int, block: int):
    """Queries with the blocks they visit and the cells they want there."""

    def wanted(cells: list[int]) -> dict[int, list[int]]:
        blocks: dict[int, list[int]] = {}
        for cell in cells:
            at, n = others[cell] if cell < 0 else (int(offset[cell]), int(number[cell]))
            for b in range(at // block, (at + n - 1) // block + 1):
                blocks.setdefault(b, []).append(cell)
        return blocks

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for dim, part in rows.groupby("dim"):
                if dim != books.dim:
                    lists = [[-dim]] * len(part)
                else:
                    lists = []
                    for first, second in zip(*books.halves(_stacked(part["vector"]))):
                        cells, passed = [], 0
                        for cell in walk(first, second):
                            if number[cell]:
                                cells.append(cell)
                                passed += int(number[cell])
                                if passed >= length:
                                    break
                        lists.append(cells)
                for q, name, vector, cells in zip(part["q"], part["id"], part["vector"], lists):
                    out += [(q, name, vector, b, c) for b, c in wanted(cells).items()]
                    if len(out) >= 4096:
                        yield pd.DataFrame(out, columns=["q", "id", "vector", "block", "cells"])
                        out = []
            if out:
                yield pd.DataFrame(out, columns=["q", "id", "vector", "block", "cells"])

    return visit


def nearest_of(asked, cells, entries, entry_cells, ids, own, k: int):
    """Rows (query, id, score): the k nearest of each query among the entries of its cells.

    ``ids`` are the ids that share an entry's vector, ``own`` a query's own id, of
    which one stands for the query and is left out. All of equal score are kept.
    """
    local = {c: n for n, c in enumerate(np.unique(entry_cells).tolist())}
    wanted = np.zeros((len(asked), len(local)), bool)
    for row, some in enumerate(cells):
        wanted[row, [local[c] for c in some if c in local]] = True
    member = np.array([local[c] for c in entry_cells.tolist()])
    top = max(np.abs(asked).max(initial=0.0), np.abs(entries).max(initial=0.0))
    scale = top if top > FAR or 0 < top < 1 / FAR else 1.0
    square = distances(asked / scale, entries / scale)
    slack = 1e-9 * np.einsum("ij,ij->i", asked / scale, asked / scale) + 1e-300
    square[~wanted[:, member]] = np.inf
    found = []
    for row in range(len(asked)):
        # The query's own vector may be among the k + 1 nearest and hold no other id.
        at = min(k, square.shape[1] - 1)
        limit = np.partition(square[row], at)[at]
        near = np.flatnonzero((square[row] <= limit * (1 + 1e-9) + 4 * slack[row]) & np.isfinite(square[row]))
        score = exact(np.broadcast_to(asked[row], (len(near), asked.shape[1])), entries[near])
        pairs = []
        for place, value in zip(near.tolist(), score.tolist()):
            names = list(ids[place])
            if value == 0 and own[row] in names and np.array_equal(asked[row], entries[place]):
                names.remove(own[row])
            pairs += [(value, name) for name in names]
        found += [(row, name, value) for value, name in sorted(pairs)[:k]]
    return found


def _block_nearest(k: int):
    def nearest(_: tuple, queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, entries in held.groupby("dim"):
            asked = queries[queries["vector"].map(len) == dim]
            if len(asked):
                found = nearest_of(
                    _stacked(asked["vector"]), asked["cells"].tolist(), _stacked(entries["vector"]),
                    entries["cell"].to_numpy(), entries["ids"].tolist(), asked["id"].tolist(), k,
                )
                q, name = asked["q"].to_numpy(), asked["id"].to_numpy()
                out += [(q[row], name[row], other, score) for row, other, score in found]
        return pd.DataFrame(out, columns=["q", "query_id", "vec_id", "score"])

    return nearest


def _cells(entries: DataFrame, books: Codebooks) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Number of entries and first place per cell, and rows (cell, place, number) of all cells."""
    number, others = np.zeros(books.size**2, np.int64), []
    for r in entries.groupBy("cell").count().collect():
        if r["cell"] < 0:
            others.append((r["cell"], r["count"]))
        else:
            number[r["cell"]] = r["count"]
    offset = np.cumsum(number) - number
    rows = [(int(c), int(offset[c]), int(number[c])) for c in np.flatnonzero(number)]
    place = int(number.sum())
    for cell, n in sorted(others):
        rows.append((cell, place, n))
        place += n
    return number, offset, rows


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column | str,
    k: int = 10,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: int = LEAST,
    block: int = BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest other rows found for each query row.

    The score is the Euclidean distance; equal scores go to the smaller id.
    ``is_query`` is a condition on the rows. Vectors with a null id, and those
    that are null, empty, zero or hold null or non-finite components take no
    part. Vectors of other lengths than the query's are no candidates; those of
    lengths other than the commonest are compared with all of their length. A
    repeated row is a candidate and a query of its own. At least ``least``
    vectors are compared with each query, so smaller tables are searched whole;
    beyond that about RECALL of the nearest are found. An empty table, or one
    without queries, gives no rows. Other columns are not read.

    Equal vectors are one entry with its k + 1 smallest ids: no more can be
    among a query's k best.
    """
    spark = vectors.sparkSession
    component = vectors[f"`{vector_col}`"]
    finite = F.forall(
        component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = vectors[f"`{id_col}`"].isNotNull() & finite & F.exists(component, lambda x: x != 0)
    rows = vectors.where(usable).select(
        vectors[f"`{id_col}`"].cast("bigint").alias("id"),
        component.alias("vector"),
        condition(is_query).alias("asks"),
    )
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    by_id = Window.partitionBy("vector").orderBy("id")
    classes = checkpoint(
        rows.withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("dim", F.size("vector"))
    )
    queries = checkpoint(
        rows.where("asks").select(
            F.monotonically_increasing_id().alias("q"), "id", "vector", F.size("vector").alias("dim")
        )
    )
    common = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None or queries.isEmpty():
        return spark.createDataFrame([], schema)
    of_length = F.col("dim") == common["dim"]
    keyed = classes.where(of_length).withColumn("key", F.col("ids")[0])
    sample = np.array([r["vector"] for r in sampled(keyed, SAMPLE, "key", "vector").collect()], float)
    books = Codebooks(sample, common["count"])
    element = dict(classes.dtypes)["vector"]
    entries = checkpoint(
        classes.mapInPandas(
            _placed(books), f"vector {element}, ids array<bigint>, dim int, cell bigint"
        )
    )
    number, offset, cells = _cells(entries, books)

    asked = [r["vector"] for r in sampled(queries.where(of_length), MEASURED, "id", "q").collect()]
    length = 0
    if asked and common["count"] > least:
        by_square = Window.partitionBy("q").orderBy("square")
        true = (
            entries.mapInPandas(_true_neighbours(asked, k), "q int, cell bigint, square double")
            .where(F.col("square") < F.lit(float("inf")))
            .withColumn("rank", F.row_number().over(by_square))
            .where(F.col("rank") <= k)
            .collect()
        )
        near: list[list[int]] = [[] for _ in asked]
        for r in true:
            near[r["q"]].append(r["cell"])
        length = walk_length(np.array(asked, float), near, books, number)

    others = {cell: (at, n) for cell, at, n in cells if cell < 0}
    visits = checkpoint(
        queries.mapInPandas(
            _visits(books, number, offset, others, max(length, least, k + 1), block),
            f"q bigint, id bigint, vector {element}, block bigint, cells array<bigint>",
        )
    )
    visited = visits.groupBy("block").agg(
        F.ceil(F.count("*") / float(QUERY_BLOCK)).cast("int").alias("parts")
    )
    visited = few(checkpoint(visited))
    layout = few(spark.createDataFrame(cells, "cell bigint, at bigint, n bigint"))
    held = (
        entries.join(layout, "cell")
        .withColumn("block", F.expr(f"(at + pmod(xxhash64(vector), n)) div {block}"))
        .join(visited, "block")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("block", "part", "vector", "ids", "dim", "cell")
    )
    dealt = visits.join(visited, "block").withColumn(
        "part", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int")
    )
    found = (
        dealt.groupBy("block", "part")
        .cogroup(held.groupBy("block", "part"))
        .applyInPandas(_block_nearest(k), "q bigint, query_id bigint, vec_id bigint, score double")
    )
    by_score = Window.partitionBy("q").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
