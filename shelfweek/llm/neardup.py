"""Near-duplicate vectors by randomised-rotation binary codes.

Every vector is scaled to length 1, rotated by one random orthogonal matrix and
reduced to the signs of its components. Stored beside the signs is the inner
product f of the code (as a unit vector) with the rotated vector. For another
unit vector y, <code, y> / f is an unbiased estimate of the cosine c. Its error
is at most sqrt(1 - c^2) * sqrt(1 - f^2) / f, so a pair with c >= t is certain
to have an estimate of at least t - sqrt(1 - t^2) * sqrt(1 - f^2) / f. Only the
pairs above that bound are recomputed, in double precision; none is lost.

Which vectors meet is decided by cells around sampled vectors: y belongs to the
cell of its closest centre and visits each cell whose border is nearer than the
largest distance that linked vectors can have. Every vector is placed; the
sample only shapes the cells.
"""

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import checkpoint, components, few, sampled

# Vectors aimed at per cell, cells at most, rows of a block that is compared at once.
CELL_ROWS = 4096
MAX_CELLS = 1 << 14
BLOCK = 2048
# Vectors held against all centres at once.
PLACED = 256
# Copies of a vector that one task may get where results are joined back to the rows.
HOT_COPIES = 1_000_000
# Pairs recomputed at a time, and room for the rounding of 32-bit estimates.
EXACT_PAIRS = 1 << 15
ROUNDING = 1e-4


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def in_range(vectors: np.ndarray) -> np.ndarray:
    """The vectors, scaled only where their squares would not fit a double."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.where((top > 1e120) | (top < 1e-120), top, 1.0)


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits, packed, and the inner product of code and vector."""
    rotated = units @ rotation(units.shape[1]).T
    factor = np.abs(rotated).sum(axis=1) / np.sqrt(units.shape[1])
    return np.packbits(rotated >= 0, axis=1), np.minimum(factor, 1.0)


def estimates(codes: np.ndarray, factors: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the cosines of coded vectors (rows) with ``units`` (columns)."""
    dim = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    rotated = (units @ rotation(dim).T).astype(np.float32)
    return (signs @ rotated.T) / (factors * np.sqrt(dim)).astype(np.float32)[:, None]


def lowest_estimate(factors: np.ndarray, threshold: float) -> np.ndarray:
    """What the estimate of a pair at or above ``threshold`` is at least."""
    width = np.sqrt(np.maximum(0.0, 1 - factors**2)) / factors
    return threshold - width * np.sqrt(max(0.0, 1 - threshold**2)) - ROUNDING


def linked_pairs(left, right, codes, factors, threshold: float, same: bool):
    """Index pairs (into left, right) with cosine >= threshold; i < j if both are one block."""
    units = unit(right)
    close = estimates(codes, factors, units) >= lowest_estimate(factors, threshold)[:, None]
    i, j = np.nonzero(np.triu(close, 1) if same else close)
    left, right = in_range(left), in_range(right)
    norms_l = np.sqrt(np.einsum("ij,ij->i", left, left))
    norms_r = np.sqrt(np.einsum("ij,ij->i", right, right))
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), EXACT_PAIRS):
        a, b = i[at : at + EXACT_PAIRS], j[at : at + EXACT_PAIRS]
        dots = np.einsum("ij,ij->i", left[a], right[b])
        keep[at : at + EXACT_PAIRS] = dots / (norms_l[a] * norms_r[b]) >= threshold
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n items over the links (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    return root


def _compare(threshold: float):
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        kind, a, b = key[3:6]
        same = kind == 0 and a == b
        home = rows["home"].to_numpy()
        at_l = (rows["block"] == a).to_numpy() if kind == 0 else home
        at_r = (rows["block"] == b).to_numpy() if kind == 0 else ~home
        ids, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        l, r = np.flatnonzero(at_l), np.flatnonzero(at_r)
        if not len(l) or not len(r):
            return pd.DataFrame({"rep": [], "links": [], "root": []})
        vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        codes = np.stack([np.frombuffer(rows["code"].iat[x], np.uint8) for x in l])
        i, j = linked_pairs(
            vectors[l], vectors[r], codes, rows["factor"].to_numpy()[l], threshold, same
        )
        i, j = l[i], r[j]
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        order = np.argsort(ids, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root = ids[order][_roots(len(ids), place[i], place[j])[place]]
        hit = links > 0
        return pd.DataFrame(
            {"rep": ids[hit], "links": links[hit].astype("int64"), "root": root[hit]}
        )

    return compare


def _place(centres: np.ndarray, reach: float):
    """Codes of the vectors, one row per cell they live in or visit."""

    def cells(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cell of each vector, and (vector, cell) for the visits."""
        close = units @ centres.T
        own = close.argmax(axis=1)
        margin = close[np.arange(len(own)), own][:, None] - close
        # Centres have length 1; a centre's border with itself is not asked for.
        apart = np.sqrt(np.maximum(2 - 2 * (centres[own] @ centres.T), 1e-12))
        # A pair is compared in the lower of its two cells.
        visits = (margin / apart <= reach) & (np.arange(len(centres)) < own[:, None])
        return own, *np.nonzero(visits)

    def place(batches):
        for rows in batches:
            for dim, part in rows.groupby("dim"):
                units = unit(np.stack(part["vector"].to_numpy()).astype(np.float64))
                codes, factors = encode(units)
                part = part.assign(code=[c.tobytes() for c in codes], factor=factors)
                if not len(centres) or dim != centres.shape[1]:
                    yield part.assign(cell=-1, home=True)
                    continue
                for at in range(0, len(part), PLACED):
                    some = part.iloc[at : at + PLACED]
                    own, visitor, cell = cells(units[at : at + PLACED])
                    yield some.assign(cell=own, home=True)
                    if len(visitor):
                        yield some.iloc[visitor].assign(cell=cell, home=False)

    return place


def _usable(vector: str, group: str):
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(
        F.col(group).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _joined_back(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Rows with the result of their vector; copies of the commonest ones are not shuffled.

    Vectors with more than HOT_COPIES copies are as few as the rows allow.
    """
    key = ["group", "vector"]
    hot = checkpoint(reps.where(F.col("copies") > HOT_COPIES))
    if hot.isEmpty():
        return rows.join(reps, key)
    hot = few(hot)
    return rows.join(hot, key).unionByName(
        rows.join(hot.select(key), key, "left_anti").join(reps, key)
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    group_col: str = "label",
    cell_rows: int = CELL_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Per row: id, n_links, component_id and kept, linking equal groups at cosine >= threshold.

    Rows with a null id or group, and null, empty, zero or non-finite vectors
    link with nothing; neither do vectors of different lengths. A row repeated
    with its id counts as a vector of its own; different vectors under one id
    are counted together where that id stands for its copies. ``threshold`` lies in (0, 1].
    Identical vectors of a group are compared once and counted with their
    number, so a group of copies costs no more than one vector. An empty table
    gives no rows. Other columns are not read. Up to MAX_CELLS * ``cell_rows``
    vectors of a group the work grows in proportion, beyond that cells grow.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(group_col).alias("group"),
        F.col(vector_col).alias("vector"),
    )
    usable = _usable("vector", "group") & F.col("id").isNotNull()
    valid = rows.where(usable)
    classes = checkpoint(
        valid.groupBy("group", "vector")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("vector"))
    )
    largest = classes.groupBy("group", "dim").count().orderBy(F.desc("count"), "dim").first()
    centres = np.zeros((0, 0))
    if largest and largest["count"] > cell_rows:
        n = min(MAX_CELLS, -(-largest["count"] // cell_rows))
        sample = sampled(classes.where(F.col("dim") == largest["dim"]), n, "rep")
        centres = np.unique(unit(np.array([r["vector"] for r in sample.collect()], float)), axis=0)
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    element = dict(classes.dtypes)["vector"]
    group_type = dict(classes.dtypes)["group"]
    placed = checkpoint(
        classes.mapInPandas(
            _place(centres, reach),
            f"`group` {group_type}, vector {element}, rep bigint, copies bigint, dim int, "
            "code binary, factor double, cell int, home boolean",
        )
    )
    cell = ["group", "dim", "cell"]
    per_block = F.lit(float(block))
    sizes = placed.groupBy(*cell).agg(
        F.ceil(F.count_if("home") / per_block).cast("int").alias("n_home"),
        F.ceil(F.count_if(~F.col("home")) / per_block).cast("int").alias("n_guest"),
    )
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("home"), F.col("n_home")).otherwise(F.col("n_guest")))
    tile = "named_struct('kind', {}, 'a', {}, 'b', {})"
    to_homes = tile.format(0, "least(block, j)", "greatest(block, j)")
    to_guests = tile.format(1, "block", "j")
    from_guest = tile.format(1, "j", "block")
    tiles = F.expr(
        f"""CASE WHEN home THEN concat(
                transform(sequence(0, n_home - 1), j -> {to_homes}),
                transform(filter(sequence(0, n_guest), j -> j < n_guest), j -> {to_guests}))
            ELSE transform(filter(sequence(0, n_home), j -> j < n_home), j -> {from_guest}) END"""
    )
    dealt = (
        placed.join(sizes, cell)
        .withColumn("block", mine.cast("int"))
        .withColumn("tile", F.explode(tiles))
        .select(*cell, "tile.kind", "tile.a", "tile.b", "block", "home", "rep", "copies",
                "vector", "code", "factor")
    )
    found = checkpoint(
        dealt.groupBy(*cell, "kind", "a", "b").applyInPandas(
            _compare(threshold), "rep bigint, links bigint, root bigint"
        )
    )
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reps = (
        classes.select("group", "vector", "rep", "copies")
        .join(links, "rep", "left")
        .join(joined, F.col("rep") == F.col("id"), "left")
        .select(
            "group", "vector", "copies",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    alone = rows.where(~usable).select("id", F.lit(0).cast("bigint"), "id")
    grouped = _joined_back(valid, reps).select("id", "links", "component")
    result = grouped.union(alone).toDF(id_col, "n_links", "component_id")
    return result.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
