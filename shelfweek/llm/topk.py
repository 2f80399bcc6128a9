"""Exact top-k search by inner product over integer vectors.

Vectors are dealt into bands by descending length. The band of the longest
vectors is searched first and gives every query a k-th best score to beat. By
Cauchy-Schwarz a query need not visit a band whose longest vector times its own
length stays below that score. Inside a band, blocks of queries and vectors are rotated
by the right singular vectors of a sample, so that the first coordinates carry
most of the length: the partial product over those plus the product of the
residual lengths bounds the score, and only pairs above the query's score are
computed, in exact integer arithmetic. The sample shapes the rotation only; all
vectors are searched.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.llm.common import checkpoint, condition, few, sampled

SAMPLE = 4096
BLOCK = 8192
QUERY_BLOCK = 512
# Vectors bounded at a time, and the share of the squared length kept by the partial sums.
STEP = 512
KEPT = 0.8
LONG = (1 << 63) - 1
# Allowed error of the cuts between bands, as a share of the rows. It shapes the bands only.
BAND_ERROR = 1e-3


def rotation(sample: np.ndarray) -> tuple[np.ndarray, int]:
    """Right singular vectors and the number of leading ones with KEPT of the squares."""
    _, sizes, v = np.linalg.svd(sample, full_matrices=True)
    squares = np.cumsum(np.pad(sizes, (0, len(v) - len(sizes))) ** 2)
    head = int(np.searchsorted(squares, KEPT * squares[-1])) + 1
    return v.T, min(head, len(v))


def integers(vectors: list) -> np.ndarray:
    """Whole numbers as int64, or as Python's own where products might not fit."""
    floats = np.array(vectors, np.float64)
    top = np.abs(floats).max(initial=0.0)
    if top * top * floats.shape[1] < float(1 << 62):
        return floats.astype(np.int64)
    return np.array([[int(x) for x in row] for row in floats], object)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise exact inner products."""
    if left.dtype == object or right.dtype == object:
        return (left.astype(object) * right.astype(object)).sum(axis=1)
    return np.einsum("ij,ij->i", left, right)


def search(queries, candidates, floors, k: int, v: np.ndarray, head: int):
    """Index triples (query, candidate, score) that hold every pair among a query's k best.

    ``floors`` are scores that a query's k-th best is known to reach. Candidates
    come by descending length. Pairs with equal ids are left out.
    """
    (q_ids, q), (c_ids, c) = queries, candidates
    floors = floors.copy()
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    q_turned, c_turned = qf @ v, cf @ v
    q_rest = np.linalg.norm(q_turned[:, head:], axis=1)
    c_rest = np.linalg.norm(c_turned[:, head:], axis=1)
    q_norm, c_norm = np.linalg.norm(qf, axis=1), np.linalg.norm(cf, axis=1)
    best = [np.empty(0, object)] * len(q)
    found = []
    for at in range(0, len(c), STEP):
        part = slice(at, at + STEP)
        slack = 1e-9 * (q_norm * c_norm[at] + 1)
        live = np.flatnonzero(q_norm * c_norm[at] + slack >= floors)
        if not len(live):
            break
        bound = q_turned[live, :head] @ c_turned[part, :head].T
        bound += q_rest[live, None] * c_rest[None, part]
        i, j = np.nonzero(bound + slack[live, None] >= floors[live, None])
        i, j = live[i], j + at
        other = q_ids[i] != c_ids[j]
        i, j = i[other], j[other]
        score = products(q[i], c[j])
        for x in np.unique(i):
            mine = i == x
            top = np.sort(np.concatenate([best[x], score[mine].astype(object)]))[::-1][:k]
            best[x] = top
            if len(top) == k:
                floors[x] = max(floors[x], float(top[-1]) - slack[x])
        found.append((i, j, score))
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0, object)
    return tuple(np.concatenate(column) for column in zip(*found))


def _block_top(k: int, v: np.ndarray, head: int):
    def top(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows[rows["asks"]]
        held = rows[~rows["asks"]].sort_values(["norm", "id"], ascending=[False, True])
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(asked) or not len(held):
            return empty
        pair = [(x["id"].to_numpy(), integers(x["vector"].tolist())) for x in (asked, held)]
        dim = pair[0][1].shape[1]
        turn = (v, head) if dim == len(v) else (np.eye(dim), dim)
        floors = asked["floor"].fillna(-np.inf).to_numpy()
        i, j, score = search(*pair, floors, k, *turn)
        if not len(i):
            return empty
        out = pd.DataFrame({"query_id": pair[0][0][i], "vec_id": pair[1][0][j], "score": score})
        out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        out = out.groupby("query_id").head(k)
        out["score"] = [max(-LONG - 1, min(LONG, int(x))) for x in out["score"]]
        return out.astype("int64")

    return top


def top_k(
    vectors: DataFrame,
    is_query: Column | str,
    k: int = 10,
    scale: int = 1024,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best other rows of each query row.

    A component x counts as floor(scale * x), the score is the integer inner
    product, equal scores go to the smaller id. ``is_query`` is a condition on
    the rows. Null ids, and vectors that are null or hold null or non-finite
    components take no part; empty vectors score 0; vectors of other lengths
    than the query's are no candidates. A repeated row counts once. Scores
    beyond a long are clamped to it after ranking inside a block. An empty
    table gives no rows. Other columns are not read.
    """
    finite = F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * scale)
    # A double of 2^62 or more is whole already, and would not fit a long.
    whole = F.transform(
        scaled, lambda x: F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)
    )
    rows = (
        vectors.where(F.col(id_col).isNotNull() & finite)
        .select(
            F.col(id_col).cast("bigint").alias("id"),
            whole.alias("vector"),
            condition(is_query).alias("asks"),
        )
        .groupBy("id", "vector")
        .agg(F.bool_or("asks").alias("asks"))
        .withColumn("dim", F.size("vector"))
        .withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))
    )
    rows = checkpoint(rows)
    total = rows.count()
    dim = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    v, head = np.eye(1), 1
    if dim and dim["dim"]:
        sample = sampled(rows.where(F.col("dim") == dim["dim"]), SAMPLE, "id")
        v, head = rotation(np.array([r["vector"] for r in sample.collect()]))
    # Band 0 has about the ``block`` longest vectors, each further one twice as many.
    shares = [1 - block * 2.0**i / total for i in range(64) if block * 2.0**i < total]
    cuts = rows.approxQuantile("norm", shares, BAND_ERROR) if shares else []
    band = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        band = F.when(F.col("norm") > cuts[i], i).otherwise(band)
    held = rows.select("id", "vector", "norm", "dim", band.cast("int").alias("band"))
    bands = checkpoint(
        held.groupBy("dim", "band").agg(
            F.max("norm").alias("longest"),
            F.ceil(F.count("*") / float(block)).cast("int").alias("cuts"),
        )
    )
    held = held.join(few(bands.drop("longest")), ["dim", "band"]).withColumn(
        "cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    )
    groups = rows.where("asks").count() // QUERY_BLOCK + 1
    asked = rows.where("asks").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    )
    deal = ["dim", "band", "cut", "part"]
    columns = [*deal, "asks", "id", "vector", "norm", "floor"]

    def searched(queries: DataFrame, wanted: DataFrame) -> DataFrame:
        reach = F.col("norm") * F.col("longest") * (1 + 1e-9) + 1
        reached = queries.join(few(wanted), "dim").where(
            F.col("floor").isNull() | (reach >= F.col("floor"))
        )
        # Only the parts of the queries that reach a band get copies of its vectors.
        visited = few(checkpoint(reached.select("dim", "band", "part").distinct()))
        visits = (
            reached.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
            .withColumn("asks", F.lit(True))
            .select(columns)
        )
        copies = (
            held.join(visited, ["dim", "band"])
            .withColumn("asks", F.lit(False))
            .withColumn("floor", F.lit(None).cast("double"))
            .select(columns)
        )
        return visits.union(copies).groupBy(*deal).applyInPandas(
            _block_top(k, v, head), "query_id bigint, vec_id bigint, score bigint"
        )

    firsts = bands.groupBy("dim").agg(F.min("band").alias("band"))
    first = bands.join(firsts, ["dim", "band"])
    rest = bands.join(firsts, ["dim", "band"], "left_anti")
    opening = checkpoint(searched(asked.withColumn("floor", F.lit(None).cast("double")), first))
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = (
        opening.withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") == k)
        .select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    )
    later = searched(asked.join(floors, "id", "left"), rest)
    return (
        opening.union(later)
        .withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
