"""Checks of the assumptions that the joins make about their inputs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.skew import HOT_ROWS, dimension_join, hot_cells, skew_join
from shelfweek.schemas import PAIR

UNDATED, UNSTOCKED = "no calendar day", "no inventory"
_DATED, _STOCKED = "__dated", "__stocked"


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    )


def marked_sales(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every sale once, with the array ``reasons`` for which the base join loses it.

    The reasons are that its date is not in the calendar, and that its store and
    product have no stock snapshot; a NULL date or key is in neither. Sales are
    read once: both marks are joined to them, days and pairs being distinct.
    """
    keys = [k.lower() for k in PAIR]
    days = calendar.select("cal_dt").distinct().withColumn(_DATED, F.lit(True))
    pairs = inventory.select(keys).distinct().withColumn(_STOCKED, F.lit(True))
    dated = dimension_join(
        sales.withColumnRenamed("trans_dt", "cal_dt"), days, ["cal_dt"], "left", hot_rows=hot_rows
    ).withColumnRenamed("cal_dt", "trans_dt")
    (sold,) = hot_cells(keys, sales, hot_rows=hot_rows)
    both = skew_join(dated, pairs, keys, "left", left_cells=sold)
    reasons = F.array_compact(
        F.array(
            F.when(F.col(_DATED).isNull(), UNDATED), F.when(F.col(_STOCKED).isNull(), UNSTOCKED)
        )
    )
    return both.withColumn("reasons", reasons).select(*sales.columns, "reasons")


def dropped_sales(
    sales: DataFrame, calendar: DataFrame, inventory: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Sales that the base join loses, with the reason, once per reason."""
    marked = marked_sales(sales, calendar, inventory, hot_rows=hot_rows)
    return marked.select(*sales.columns, F.explode("reasons").alias("reason"))
