"""The joins between sales, calendar and inventory."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.counted import COPIES, unroll_spread
from shelfweek.operators.skew import (
    HOT_PRODUCT,
    HOT_ROWS,
    by_bucket,
    dimension_join,
    hot_cells,
    skew_join,
)
from shelfweek.schemas import PAIR, SALE_MEASURES, STOCK

BASE = ["YR_NUM", "WK_NUM", "DAY_OF_WK_NUM", "MNTH_NUM", *PAIR, *SALE_MEASURES, *STOCK]


def sale_lines(sales: DataFrame) -> DataFrame:
    """The sales columns the metrics need, dated by ``CAL_DT``.

    Measures that were inferred as doubles are rounded to their declared two
    decimals, row by row. Their sums are then exact and the same whatever order
    they are added in, also when a lost task is run again.
    """
    types = {name.upper(): kind for name, kind in sales.dtypes}

    def exact(name):
        column = F.col(name)
        return column.cast("decimal(18,2)") if types[name] in ("double", "float") else column

    return sales.select(
        F.col("trans_dt").alias("CAL_DT"),
        *(F.col(c).alias(c) for c in PAIR),
        *(exact(c).alias(c) for c in SALE_MEASURES),
    )


def _declared(df: DataFrame, name: str) -> Column:
    """Stock quantities that were inferred as other numbers get their declared type."""
    kind = {n.upper(): t for n, t in df.dtypes}[name]
    want = "int" if name == "OUT_OF_STOCK_FLG" else "decimal(18,2)"
    given = kind.startswith("decimal") or kind == want
    return (F.col(name) if given else F.col(name).cast(want)).alias(name)


def calendar_days(calendar: DataFrame) -> DataFrame:
    names = ("CAL_DT", "YR_NUM", "WK_NUM", "DAY_OF_WK_NUM", "MNTH_NUM")
    return calendar.select(*(F.col(c).alias(c) for c in names))


def stock_snapshots(inventory: DataFrame) -> DataFrame:
    keys = (F.col(c).alias(c) for c in PAIR)
    return inventory.select(*keys, *(_declared(inventory, c) for c in STOCK))


def dated_snapshots(inventory: DataFrame) -> DataFrame:
    keys = (F.col(c).alias(c) for c in ("CAL_DT", *PAIR))
    return inventory.select(*keys, *(_declared(inventory, c) for c in STOCK))


def sales_calendar(
    sales: DataFrame, calendar: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Sales lines with their year, week, day and month; undated sales drop out."""
    return dimension_join(
        sale_lines(sales), calendar_days(calendar), ["CAL_DT"], hot_rows=hot_rows
    ).drop("CAL_DT")


def base_join(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame, *, hot_rows: int = HOT_ROWS,
    hot_product: int = HOT_PRODUCT, shape: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every dated sale with every stock snapshot of its store and product.

    The snapshot's own date is not compared: a sale meets the whole stock
    history of its pair. The operators built on top of this join reach the
    same results without materializing it.

    Hot pairs, by their rows or by the rows they join to, are counted first, as
    a pair's many rows are mostly equal: equal rows are combined map-side, joined
    in a grid of cells and repeated last, where they are unless one has many
    copies. All other pairs are joined as they are.

    ``shape`` is what else is to become of each row by itself, such as other column
    types: it is done once for all copies of a row, before they are repeated.
    """
    snapshots = stock_snapshots(inventory)
    cells = hot_cells(
        PAIR, sale_lines(sales), snapshots, hot_rows=hot_rows, hot_product=hot_product
    )
    dated = sales_calendar(sales, calendar, hot_rows=hot_rows)
    return _counted_join(dated, snapshots, PAIR, *cells, shape).select(BASE)


def base_join_dated(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame, *, hot_rows: int = HOT_ROWS,
    hot_product: int = HOT_PRODUCT,
) -> DataFrame:
    """Every dated sale with the stock snapshot of the same day, store and product."""
    keys = ["CAL_DT", *PAIR]
    lines, snapshots = sale_lines(sales), dated_snapshots(inventory)
    cells = hot_cells(keys, lines, snapshots, hot_rows=hot_rows, hot_product=hot_product)
    matched = _counted_join(lines, snapshots, keys, *cells)
    return dimension_join(
        matched, calendar_days(calendar), ["CAL_DT"], load=lines, hot_rows=hot_rows
    ).select(BASE)


def _counted_join(left, right, keys, left_cells, right_cells, shape=None) -> DataFrame:
    """Inner join that joins the rows of hot buckets as counted rows, shaped before they are repeated."""
    shape = shape or (lambda rows: rows)
    hot = sorted({*left_cells, *right_cells})
    if not hot:
        return shape(left.join(right, keys))
    cold_l, hot_l = by_bucket(left, keys, hot)
    cold_r, hot_r = by_bucket(right, keys, hot)
    joined = skew_join(
        _counts(hot_l, "n_l"), _counts(hot_r, "n_r"), keys,
        left_cells=left_cells, right_cells=right_cells, fixed=True,
    )
    counted = joined.withColumn(COPIES, F.col("n_l") * F.col("n_r")).drop("n_l", "n_r")
    return shape(cold_l.join(cold_r, keys)).unionByName(unroll_spread(shape(counted)))


def _counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))
