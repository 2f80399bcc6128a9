"""Centroid clustering, exact in integers, with norm-of-sum bounds.

Every vector keeps, for each centroid, its distance as last evaluated and the
round of that evaluation. The centroids of all rounds are kept as well, so a
bound is loosened by the norm of the centroid's total displacement since then,
which is at most the sum of its drifts in the rounds between. A vector stays
where it is if its own centroid, at its farthest, is nearer than every other at
its nearest; the others evaluate their own distance again and then only those
centroids that the bounds leave open, in exact integers.

A round is one pass over the vectors and their bounds, written as a table, and
one aggregation over the vectors that changed their centroid: sums are integers,
so they are kept up to date without rounding. What the driver holds is the
centroids.
"""

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.sinks.scratch import removed, staged

# Room for the rounding of distances: relative, and absolute in units of the integers.
SLACK = 1e-9
# Products up to this size add up exactly in a double, over the components of a vector.
EXACT = float(1 << 52)
# Rows of differences held at once, and partial sums per centroid.
PAIRS = 1 << 14
PARTS = 256


def largest_component(dim: int) -> int:
    """What a component may be so that every squared distance fits a long."""
    return isqrt(((1 << 63) - 1) // dim) // 2


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors (rows) to all centroids (columns)."""
    top = float(max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)))
    if 4 * top * top * vectors.shape[1] < EXACT:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        square = np.einsum("ij,ij->i", v, v)[:, None] + np.einsum("ij,ij->i", c, c)
        return (square - 2 * (v @ c.T)).astype(np.int64)
    i, k = np.divmod(np.arange(len(vectors) * len(centroids)), len(centroids))
    return squared_pairs(vectors, centroids, i, k).reshape(len(vectors), len(centroids))


def squared_pairs(vectors, centroids, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Exact squared distances of the pairs (vectors[i], centroids[k])."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), PAIRS):
        part = slice(at, at + PAIRS)
        difference = vectors[i[part]] - centroids[k[part]]
        out[part] = np.einsum("ij,ij->i", difference, difference)
    return out


def rounded_down(distances: np.ndarray) -> np.ndarray:
    """As 32-bit numbers that are no larger."""
    return np.nextafter(distances.astype(np.float32), np.float32(-np.inf))


class Bounds:
    """Distances of a block of vectors as last evaluated.

    ``cluster`` is a vector's centroid, ``near`` its distance to it, ``lower`` no
    more than its distance to each centroid in the round ``seen``.
    """

    def __init__(self, cluster, near, lower, seen):
        self.cluster, self.near, self.lower, self.seen = cluster, near, lower, seen

    @classmethod
    def first(cls, vectors: np.ndarray, centroids: np.ndarray) -> "Bounds":
        square = squared(vectors, centroids)
        cluster = square.argmin(axis=1)
        distance = np.sqrt(square.astype(np.float64))
        near = distance[np.arange(len(vectors)), cluster]
        return cls(cluster, near, rounded_down(distance), np.zeros(square.shape, np.int16))

    def moved(self, vectors: np.ndarray, history: np.ndarray) -> int:
        """Reassigns to the last centroids of ``history``; the number of distances evaluated.

        Equal distances go to the smaller number.
        """
        now, centroids = len(history) - 1, history[-1]
        shift = np.sqrt(((history - centroids).astype(np.float64) ** 2).sum(axis=2)) * (1 + SLACK)
        every = np.arange(len(centroids))
        low = self.lower - shift[self.seen, every]
        own = np.arange(len(vectors)), self.cluster
        low[own] = np.inf
        far = self.near + shift[self.seen[own], self.cluster]
        failed = np.flatnonzero(low.min(axis=1) <= far * (1 + SLACK) + SLACK)
        if not len(failed):
            return 0
        mine = self.cluster[failed]
        best = squared_pairs(vectors, centroids, failed, mine)
        near = np.sqrt(best.astype(np.float64))
        self.near[failed] = near
        self.lower[failed, mine], self.seen[failed, mine] = rounded_down(near), now
        row, k = np.nonzero(low[failed] <= (near * (1 + SLACK) + SLACK)[:, None])
        square = squared_pairs(vectors, centroids, failed[row], k)
        distance = np.sqrt(square.astype(np.float64))
        self.lower[failed[row], k], self.seen[failed[row], k] = rounded_down(distance), now
        # The smallest by distance, then number, of each row's evaluated centroids and its own.
        row = np.concatenate([np.arange(len(failed)), row])
        k, square = np.concatenate([mine, k]), np.concatenate([best, square])
        order = np.lexsort((k, square, row))
        first = order[np.unique(row[order], return_index=True)[1]]
        self.cluster[failed], self.near[failed] = k[first], np.sqrt(square[first].astype(np.float64))
        return len(row)


STATE = "id bigint, vector array<int>, cluster int, was int, near double, lower binary, seen binary"
RESULT = "id bigint, cluster int, distance bigint"


def _vectors(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _matrix(column: pa.Array, kind: str, rows: int) -> np.ndarray:
    return np.frombuffer(bytearray(b"".join(column.to_pylist())), kind).reshape(rows, -1)


def _written(rows: pa.RecordBatch, was: np.ndarray, bounds: Bounds) -> pa.RecordBatch:
    columns = [
        rows["id"], rows["vector"], pa.array(bounds.cluster.astype(np.int32)),
        pa.array(was.astype(np.int32)), pa.array(bounds.near),
        pa.array([x.tobytes() for x in bounds.lower.astype("<f4")], pa.binary()),
        pa.array([x.tobytes() for x in bounds.seen.astype("<i2")], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, STATE.replace(",", "").split()[::2])


def _read(rows: pa.RecordBatch, dim: int) -> tuple[np.ndarray, Bounds]:
    kept = Bounds(
        rows["cluster"].to_numpy().astype(np.int64),
        rows["near"].to_numpy().copy(),
        _matrix(rows["lower"], "<f4", rows.num_rows),
        _matrix(rows["seen"], "<i2", rows.num_rows),
    )
    return _vectors(rows["vector"], dim), kept


def _first(centroids: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                bounds = Bounds.first(_vectors(rows["vector"], centroids.shape[1]), centroids)
                yield _written(rows, np.full(rows.num_rows, -1), bounds)

    return assign


def _again(history: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                vectors, bounds = _read(rows, history.shape[2])
                was = bounds.cluster.copy()
                bounds.moved(vectors, history)
                yield _written(rows, was, bounds)

    return assign


def _last(history: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                vectors, bounds = _read(rows, history.shape[2])
                bounds.moved(vectors, history)
                own = squared_pairs(vectors, history[-1], np.arange(len(vectors)), bounds.cluster)
                columns = [rows["id"], pa.array(bounds.cluster.astype(np.int32)), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return assign


def _changes(state: DataFrame, dim: int) -> list:
    """Rows (cluster, n, total): what the vectors that changed add to each centroid's number and sum."""
    change = F.expr(
        "explode(filter(array(named_struct('k', cluster, 'sign', 1), named_struct('k', was, 'sign', -1)),"
        " x -> x.k >= 0))"
    )
    signed = (
        state.where("cluster <> was")
        .select("vector", change.alias("change"), F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part"))
        .select("vector", "change.k", "change.sign", "part")
    )
    totals = [F.sum(F.col("vector")[j] * F.col("sign").cast("bigint")).alias(f"s{j}") for j in range(dim)]
    parts = signed.groupBy("k", "part").agg(F.sum("sign").alias("n"), *totals)
    # Longs hold the sum of a part, decimals that of all.
    whole = [F.sum(F.col(f"s{j}").cast("decimal(38,0)")).alias(f"s{j}") for j in range(dim)]
    rows = parts.groupBy("k").agg(F.sum("n").alias("n"), *whole).collect()
    return [(r["k"], r["n"], [int(r[f"s{j}"]) for j in range(dim)]) for r in rows]


def cluster(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    scale: int = 256,
    dim: int = 64,
    seed: int | str = 2,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per vector: id, cluster, distance, cluster_inertia, inertia, centroid.

    Vectors of ``dim`` components, none null or non-finite, take part as integers
    floor(scale * x); components beyond ``largest_component`` (134 million over
    the scale, for 64 components) count as that, so that distances fit a long.
    Centroids start as the vectors whose text "seed:id" has the smallest SHA-256,
    of repeated ids the smaller vector first, null ids last; with fewer vectors
    there are fewer centroids. Each of ``rounds`` rounds assigns every vector to
    the nearest centroid (squared distance; ties: smaller number) and replaces
    each centroid that has vectors by the floor of their mean. Then they are
    assigned once more.

    distance is squared, the inertias are its sums over the cluster and over all
    (a long at most), centroid is the cluster's array of components. Repeated
    rows are vectors of their own. Without a vector that takes part there are no
    rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    component = vectors[f"`{vector_col}`"]
    finite = F.forall(
        component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    limit = float(largest_component(dim))
    whole = F.transform(
        component,
        lambda x: F.floor(
            F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * float(scale)))
        ).cast("int"),
    )
    kept = vectors.where((F.size(component) == dim) & finite).select(
        vectors[f"`{id_col}`"].cast("bigint").alias("id"), whole.alias("vector")
    )
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(drawn.asc_nulls_last(), "vector").limit(clusters).collect()
    schema = (
        f"`{id_col}` bigint, cluster int, distance bigint, cluster_inertia bigint, "
        "inertia bigint, centroid array<bigint>"
    )
    if not starts:
        return spark.createDataFrame([], schema)
    history = np.array([[r["vector"] for r in starts]], np.int64)
    number = [0] * len(starts)
    total = [[0] * dim for _ in starts]
    made: list[str] = []
    state = staged(kept.mapInArrow(_first(history[0]), STATE), "clusters", made)
    for done in range(1, rounds + 1):
        for k, n, added in _changes(state, dim):
            number[k] += n
            total[k] = [a + b for a, b in zip(total[k], added)]
        means = [
            [x // number[k] for x in total[k]] if number[k] else history[-1][k].tolist()
            for k in range(len(starts))
        ]
        history = np.concatenate([history, np.array([means], np.int64)])
        if done < rounds:
            state = staged(state.mapInArrow(_again(history), STATE), "clusters", made)
            removed(spark, made.pop(0))
    final = staged(state.mapInArrow(_last(history), RESULT), "clusters", made)
    removed(spark, made.pop(0))
    inertia = {
        r["cluster"]: int(r["sum"])
        for r in final.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
        .collect()
    }
    most = (1 << 63) - 1
    every = min(most, sum(inertia.values()))
    about = spark.createDataFrame(
        [(k, min(most, x), every, history[-1][k].tolist()) for k, x in inertia.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>",
    )
    # One row per centroid.
    joined = final.join(F.broadcast(about), "cluster")
    return joined.select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
