"""Joins that stay balanced when one key holds a large share of the rows."""

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes a side may have before it is shuffled rather than broadcast.
BROADCAST_BYTES = 64 << 20
# Keys are counted by hash bucket first, so that count never returns more rows than this,
# and fewer where the frames are small: one per so many bytes, at least LEAST_BUCKETS.
BUCKETS, LEAST_BUCKETS = 1 << 16, 1 << 10
BUCKET_BYTES = 8 << 10
# A key is hot when it has more rows than one task should get, or joins to more.
HOT_ROWS = 1_000_000
HOT_PRODUCT = 16_000_000
# Cells no smaller than a task's even share of all hot rows over this: smaller ones are
# copied more often and spread no better.
SHARES = 32

# Types of keys that equal numbers of another width match.
WHOLE = ("tinyint", "smallint", "int", "bigint")

_CELL_L, _CELL_R, _BUCKET = "__cell_l", "__cell_r", "__bucket"


def _width(df: DataFrame) -> Column:
    """About the bytes of a row: the length of text, arrays by their elements, else 8."""
    parts = [F.lit(16)]
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)) + 8)
        elif kind.startswith(("array", "map")):
            parts.append(F.greatest(F.size(column), F.lit(0)) * 16 + 16)
        else:
            parts.append(F.lit(8 * (1 + kind.count(","))))
    return reduce(Column.__add__, parts).cast("bigint")


def checked_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame | None:
    """``df`` marked for broadcast, or None when it is larger than ``max_bytes``.

    The rows are read once to be measured.
    """
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = df.select(_width(df).alias("width")).agg(F.sum("width")).first()[0] or 0
    return F.broadcast(df) if size <= limit else None


def _bucket(df: DataFrame, keys: list[str]) -> Column:
    # Both sides must hash alike whatever integer width their keys have.
    types = dict(df.dtypes)
    parts = [
        F.col(k).cast("bigint") if types[k] in ("tinyint", "smallint", "int") else F.col(k)
        for k in keys
    ]
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def _coarse_buckets(frames) -> int:
    """Groups of hash buckets to begin with, by the planner's estimate of the frames' sizes.

    Whatever it is, counts are exact and no hot key is missed: coarser groups
    are only passed on to the count by key more often.
    """
    plans = (frame._jdf.queryExecution().optimizedPlan() for frame in frames)
    size = max(int(str(plan.stats().sizeInBytes())) for plan in plans)
    groups = LEAST_BUCKETS
    while groups < BUCKETS and groups * BUCKET_BYTES < size:
        groups *= 2
    return groups


def hot_cells(
    keys: list[str],
    *frames: DataFrame,
    hot_rows: int = HOT_ROWS,
    hot_product: int | None = None,
) -> list[dict[int, int]]:
    """Per frame, the hash buckets that hold a hot key and into how many cells to cut it.

    A key is hot with more than ``hot_rows`` rows in a frame. With two frames
    that are joined and a ``hot_product``, it also is when its rows in one times
    its rows in the other are more than that, and the cells then bound the
    product that one of them makes. Where there is more in all hot keys than that
    many rows for each task, a cell is a part of a task's even share instead: see
    ``SHARES``.

    Rows are counted exactly and map-side combined, by groups of buckets first:
    a group bounds the rows of all of its keys, so those without enough rows for
    a hot key are done with, and only the others are counted by key. Where nearly
    all groups must have enough, keys are counted at once. Groups of
    parts of a frame add up. What reaches the driver is a number per bucket with a hot
    key, whatever the data.
    """
    cells = [{} for _ in frames]
    groups, crowded = _coarse_buckets(frames), False
    if hot_product is None:
        # A frame with no more rows than that has no such key; this only counts rows.
        largest = max(frame.count() for frame in frames)
        if largest <= hot_rows:
            return cells
        # Groups that hold more than a hot key's rows on average dismiss next to no key.
        crowded = largest > hot_rows * groups
    whole = [all(dict(frame.dtypes)[k] in WHOLE for frame in frames) for k in keys]
    keyed = [
        frame.select(F.lit(i).alias("frame"), _bucket(frame, keys).alias("bucket"), *_names(keys, whole))
        for i, frame in enumerate(frames)
    ]
    rows = reduce(DataFrame.unionAll, keyed)
    names = [f"key_{n}" for n in range(len(keys))]
    by_frame = [F.sum(F.when(F.col("frame") == i, 1).otherwise(0)).alias(f"n_{i}") for i in range(len(frames))]
    counts = [F.col(f"n_{i}").cast("double") for i in range(len(frames))]
    hot = reduce(Column.__or__, [n > hot_rows for n in counts])
    if hot_product is not None:
        hot |= counts[0] * counts[1] > hot_product
    if not crowded:
        rows = rows.withColumn("group", F.col("bucket") % groups)
        large = rows.groupBy("group").agg(*by_frame).where(hot).select("group").collect()
        if not large:
            return cells
        some = frames[0].sparkSession.createDataFrame(large, "group int")
        rows = rows.join(F.broadcast(some), "group")
    product = counts[0] * counts[1] if hot_product is not None else F.lit(0.0)
    found = (
        rows.groupBy("bucket", *names)
        .agg(*by_frame)
        .where(hot)
        .select("bucket", product.alias("product"), *counts)
        .toDF("bucket", "product", *(f"n_{i}" for i in range(len(frames))))
        .groupBy("bucket")
        .agg(*[how(c).alias(f"{name}_{c}") for c in ("product", *(f"n_{i}" for i in range(len(frames)))) for name, how in (("max", F.max), ("sum", F.sum))])
        .collect()
    )
    tasks = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = lambda name, limit: max(limit, sum(row[f"sum_{name}"] for row in found) / (SHARES * tasks))
    most = [share(f"n_{i}", hot_rows) for i in range(len(frames))]
    most_product = hot_product and share("product", hot_product)
    for row in found:
        ns = [row[f"max_n_{i}"] for i in range(len(frames))]
        cut = _cut(ns, row["max_product"], most, most_product)
        for i, (own, n_cells) in enumerate(zip(cells, cut)):
            # A hot key is told even if its share is one cell: the frame with most of its rows has it.
            if n_cells > 1 or (max(cut) == 1 and i == ns.index(max(ns))):
                own[row["bucket"]] = n_cells
    return cells


def _names(keys: list[str], whole: list[bool]) -> list[Column]:
    # One type in all frames; numbers are counted as such, which is cheaper than as text.
    return [
        F.col(k).cast("bigint" if w else "string").alias(f"key_{n}")
        for n, (k, w) in enumerate(zip(keys, whole))
    ]


def _cut(counts: list[float], product: float, most: list[float], most_product: float | None) -> list[int]:
    """Cells per frame so that one holds no more than the limits."""
    cells = [ceil(n / limit) for n, limit in zip(counts, most)]
    if most_product is not None:
        # About square pieces copy the fewest rows; a side shorter than that is not cut.
        side = most_product**0.5
        left, right = counts
        cells = [
            max(own, ceil(product / most_product) if other <= side else ceil(n / side))
            for own, n, other in ((cells[0], left, right), (cells[1], right, left))
        ]
    return cells


def by_bucket(df: DataFrame, keys: list[str], buckets: list[int]) -> tuple[DataFrame, DataFrame]:
    """The rows outside the given hash buckets of ``keys``, and those inside."""
    some = df.sparkSession.createDataFrame([(b,) for b in buckets], f"{_BUCKET} int")
    placed = df.withColumn(_BUCKET, _bucket(df, keys))
    return (
        placed.join(F.broadcast(some), _BUCKET, "left_anti").select(df.columns),
        placed.join(F.broadcast(some), _BUCKET, "left_semi").select(df.columns),
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    left_cells: dict[int, int] | None = None,
    right_cells: dict[int, int] | None = None,
    fixed: bool = False,
) -> DataFrame:
    """Equi-join on ``keys`` that cuts hot keys into a grid of smaller joins.

    The cells come from ``hot_cells`` of the cheapest frames whose rows per key
    are those of each side, usually the bare tables; none are needed for a side
    with few rows per key. Without hot keys this is a plain join. With them, a
    hot left row goes to one row of the grid and is copied to each column, a hot
    right row the other way round, so every pair of rows meets exactly once.
    Joins other than inner can only cut the left side.

    A row's place is a hash of the row, so that a recomputed task places its
    rows as before. Exact copies of one row therefore share a cell; where there
    may be many, count them first and join the counted rows. With ``fixed`` the
    cells go to the given number of shuffle partitions, which adaptive merging by
    size then leaves alone: for rows that stand for many more.
    """
    cells_l = left_cells or {}
    cells_r = (right_cells or {}) if how == "inner" else {}
    # A grid of one cell is a plain join too, and may use the order the sides are in.
    cut = any(n > 1 for n in (*cells_l.values(), *cells_r.values()))
    if not cut and not (fixed and (cells_l or cells_r)):
        return left.join(right, keys, how)

    grid = left.sparkSession.createDataFrame(
        [(b, cells_l.get(b, 1), cells_r.get(b, 1)) for b in sorted({*cells_l, *cells_r})],
        f"{_BUCKET} int, __n_l int, __n_r int",
    )

    def place(df, own, n_own, other, n_other):
        payload = df.columns
        row_hash = F.xxhash64(*payload, F.lit(own))
        return (
            df.withColumn(_BUCKET, _bucket(df, keys))
            .join(F.broadcast(grid), _BUCKET, "left")
            .select(
                *payload,
                F.pmod(row_hash, F.coalesce(n_own, F.lit(1))).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.coalesce(n_other, F.lit(1)) - 1)).alias(other),
            )
        )

    n_l, n_r = F.col("__n_l"), F.col("__n_r")
    placed_l = place(left, _CELL_L, n_l, _CELL_R, n_r)
    placed_r = place(right, _CELL_R, n_r, _CELL_L, n_l)
    placed_keys = [*keys, _CELL_L, _CELL_R]
    if fixed:
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed_l, placed_r = (p.repartition(tasks, *placed_keys) for p in (placed_l, placed_r))
    return placed_l.join(placed_r, placed_keys, how).drop(_CELL_L, _CELL_R)


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    load: DataFrame | None = None,
    max_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join to a table that is broadcast if its measured size allows, else shuffled.

    ``load`` is a cheaper frame with the rows per key of ``facts``, if there is one.
    Both are read while the join is being planned.
    """
    small = checked_broadcast(dim, max_bytes)
    if small is not None:
        return facts.join(small, keys, how)
    (cells,) = hot_cells(keys, facts if load is None else load, hot_rows=hot_rows)
    return skew_join(facts, dim, keys, how, left_cells=cells)
