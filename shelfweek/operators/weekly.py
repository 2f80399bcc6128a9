"""Weekly metrics per store and product."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.functions.measures import low_stock_flag, weekly_metrics
from shelfweek.operators.joins import (
    calendar_days,
    dated_snapshots,
    sale_lines,
    sales_calendar,
    stock_snapshots,
)
from shelfweek.operators.skew import (
    HOT_ROWS,
    checked_broadcast,
    dimension_join,
    hot_cells,
    skew_join,
)
from shelfweek.schemas import GRAIN, PAIR, STOCK
from shelfweek.sinks.scratch import staged

DAY = ["CAL_DT", *PAIR]
LOW_STOCK = [*GRAIN, "INVENTORY_ON_HAND_QTY", "SALES_QTY", "LOW_STOCK_FLG"]


def low_stock(base: DataFrame) -> DataFrame:
    """Joined rows with a flag for stock below the quantity of that sale."""
    flag = low_stock_flag(F.col("INVENTORY_ON_HAND_QTY"), F.col("SALES_QTY"))
    return base.withColumn("LOW_STOCK_FLG", flag).select(LOW_STOCK)


def totals(base: DataFrame) -> DataFrame:
    """The six metrics of joined rows, one row per year, week, store and product."""
    sums = base.groupBy(*GRAIN).agg(
        F.sum("SALES_QTY").alias("qty"),
        F.sum("SALES_AMT").alias("amt"),
        F.sum("SALES_COST").alias("cost"),
        F.sum("OUT_OF_STOCK_FLG").alias("outs"),
    )
    return sums.select(*GRAIN, *_named_metrics("qty", "amt", "cost", F.col("outs")))


def weekly_totals(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``totals(base_join(...))`` without the joined rows.

    Sales are summed per week and snapshots per pair before they meet. Each of
    a week's n sales would be joined to all k snapshots of its pair, so the sums
    over sales grow k-fold and the sums over snapshots n-fold. The join has one
    row per pair on one side and at most one per week on the other, so no key
    is hot in it.

    Without a hot pair the sales are shuffled once, by pair, for the sums and
    the join. With one they are first combined map-side, per week and pair.
    """
    dated = sales_calendar(sales, calendar, hot_rows=hot_rows)
    (sold,) = hot_cells(PAIR, sale_lines(sales), hot_rows=hot_rows)
    if not sold:
        dated = dated.repartition(*PAIR)
    weeks = dated.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.sum("SALES_QTY").alias("qty"),
        F.sum("SALES_AMT").alias("amt"),
        F.sum("SALES_COST").alias("cost"),
    )
    history = (
        stock_snapshots(inventory)
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("n_snapshots"), F.sum("OUT_OF_STOCK_FLG").alias("outs"))
    )
    return weeks.join(history, PAIR).select(*GRAIN, *history_metrics())


def history_metrics() -> list:
    """Metrics of a week's own sums (n_sales, qty, amt, cost) met by k snapshots.

    The price is the same with and without the factor k, so it is divided
    before the totals are scaled up.
    """
    k = F.col("n_snapshots")
    scaled = weekly_metrics(
        F.col("qty") * k, F.col("amt") * k, F.col("cost") * k, F.col("n_sales") * F.col("outs")
    )
    own = weekly_metrics(F.col("qty"), F.col("amt"), F.col("cost"), F.col("outs"))
    scaled["AVG_SALES_PRICE"] = own["AVG_SALES_PRICE"]
    return [column.alias(name) for name, column in scaled.items()]


def _named_metrics(qty, amt, cost, outs):
    metrics = weekly_metrics(F.col(qty), F.col(amt), F.col(cost), outs)
    return [column.alias(name) for name, column in metrics.items()]


def weekly_summary(
    sales: DataFrame,
    calendar: DataFrame,
    inventory: DataFrame,
    week_end_day: int = 6,
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per year, week, store and product over same-day stock.

    Equal to grouping ``base_join_dated`` where a pair has one snapshot a day;
    of several, the one that shows the least stock counts. Sales and snapshots
    are shuffled once, together, by pair: the days of a pair, which are grouped
    from both, and its weeks then are where the rows are. With a hot pair both
    sides are instead reduced to one row per day, store and product first, which
    combines map-side, leaves no hot key and gives the join its partitioning. The
    largest sale of the day tells whether any of its sales exceeded the stock.
    """
    lines = sale_lines(sales)
    if any(hot_cells(PAIR, lines, stock_snapshots(inventory), hot_rows=hot_rows)):
        joined = _sold(lines).join(daily_snapshots(inventory), DAY)
    else:
        joined = _days_by_pair(lines, dated_snapshots(inventory))
    days = dimension_join(
        joined, calendar_days(calendar), ["CAL_DT"], load=lines, hot_rows=hot_rows
    )
    week_end = F.col("DAY_OF_WK_NUM") == week_end_day
    low = low_stock_flag(F.col("INVENTORY_ON_HAND_QTY"), F.col("largest_sale"))
    weeks = days.groupBy(*GRAIN).agg(
        F.sum("qty").alias("qty"),
        F.sum("amt").alias("amt"),
        F.sum("cost").alias("cost"),
        F.sum(F.col("n_sales") * F.col("OUT_OF_STOCK_FLG")).alias("outs"),
        *(F.max(F.when(week_end, F.col(c))).alias(c) for c in STOCK),
        F.max(low).alias("LOW_STOCK_FLG"),
    )
    return weeks.select(
        *GRAIN,
        *_named_metrics("qty", "amt", "cost", F.col("outs")),
        *STOCK,
        "LOW_STOCK_FLG",
    )


def _sales_of_day() -> list:
    return [
        F.sum("SALES_QTY").alias("qty"),
        F.sum("SALES_AMT").alias("amt"),
        F.sum("SALES_COST").alias("cost"),
        F.max("SALES_QTY").alias("largest_sale"),
    ]


def _sold(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*DAY).agg(F.count(F.lit(1)).alias("n_sales"), *_sales_of_day())


def _days_by_pair(lines: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``_sold`` joined to ``daily_snapshots``, by one shuffle and one grouping of both."""
    # The union gives keys the wider type of both, as a join would to compare them.
    types = dict(lines.dtypes)
    both = lines.withColumn("sold", F.lit(1)).unionByName(
        snapshots.withColumn("sold", F.lit(0)), allowMissingColumns=True
    )
    days = both.dropna(subset=DAY).repartition(*PAIR).groupBy(*DAY).agg(
        F.sum("sold").alias("n_sales"),
        *_sales_of_day(),
        F.min(F.when(F.col("sold") == 0, _stock_order())).alias("s"),
    )
    return days.filter("n_sales > 0 AND s IS NOT NULL").select(
        *(F.col(c).cast(types[c]).alias(c) for c in DAY),
        *("n_sales", "qty", "amt", "cost", "largest_sale"),
        *_stock_of("s"),
    )


def _stock_order():
    """A snapshot's stock, ordered by how little it shows; equal ones are equal in all of STOCK."""
    on_hand, on_order = STOCK[:2]
    return F.struct(
        F.coalesce(-F.col("OUT_OF_STOCK_FLG"), F.lit(1)).alias("flag_order"),
        F.col(on_hand).isNull().alias("no_hand"),
        on_hand,
        F.col(on_order).isNull().alias("no_order"),
        *STOCK[1:],
    )


def _stock_of(struct: str) -> list:
    return [F.col(f"{struct}.{c}").alias(c) for c in STOCK]


def daily_snapshots(inventory: DataFrame) -> DataFrame:
    """One snapshot per day, store and product: the one that shows the least stock.

    That is one flagged as out of stock if there is any, then the one with the
    least on hand, then the least on order; NULL counts as no statement.
    """
    days = dated_snapshots(inventory).groupBy(*DAY).agg(F.min(_stock_order()).alias("s"))
    return days.select(*DAY, *_stock_of("s"))


def in_stock_pct(weekly: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Adds the share of the week's seven days on which the product was not out of stock.

    Days count once, whether or not there was a sale on them; a day without a
    snapshot is not known to be out of stock.
    """
    flagged = dated_snapshots(inventory).filter("OUT_OF_STOCK_FLG = 1").select("CAL_DT", *PAIR)
    out_days = dimension_join(
        flagged.distinct(), calendar_days(calendar).distinct(), ["CAL_DT"]
    ).groupBy(*GRAIN)
    out_days = out_days.agg(F.count_distinct("CAL_DT").alias("out_days"))
    share = 100 - F.coalesce("out_days", F.lit(0)) / 7 * 100
    return (
        weekly.join(out_days, GRAIN, "left")
        .withColumn("IN_STOCK_PCT", F.round(F.greatest(share, F.lit(0.0)), 3))
        .drop("out_days")
    )


def enrich(
    fact: DataFrame,
    store: DataFrame,
    product: DataFrame,
    *,
    max_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fact rows with the attributes of their store and product, where known.

    A dimension that is small, as measured, is broadcast. If one is not, the
    fact is staged first, so that counting its keys does not compute it again.
    """
    dims = [
        (store.withColumnRenamed("store_key", "STORE_KEY"), ["STORE_KEY"]),
        (product.withColumnRenamed("prod_key", "PROD_KEY"), ["PROD_KEY"]),
    ]
    small = [checked_broadcast(dim, max_bytes) for dim, _ in dims]
    if None in small:
        fact = staged(fact, "fact")
    rows = fact
    for (dim, keys), copy in zip(dims, small):
        if copy is not None:
            rows = rows.join(copy, keys, "left")
        else:
            (cells,) = hot_cells(keys, fact, hot_rows=hot_rows)
            rows = skew_join(rows, dim, keys, "left", left_cells=cells)
    return rows
