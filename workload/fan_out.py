"""The weekly fact by plain joins of the joined rows: the shape to beat.

Kept for the benchmark and for tests that compare it with the counted plans.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.weekly import low_stock, totals
from shelfweek.schemas import FACT, GRAIN, PAIR, SALE_MEASURES, STOCK


def fan_out_base(sales: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    days = calendar.withColumnRenamed("cal_dt", "trans_dt")
    joined = sales.join(days, "trans_dt").join(
        inventory.drop("cal_dt"), [key.lower() for key in PAIR]
    )
    names = ["YR_NUM", "WK_NUM", "DAY_OF_WK_NUM", "MNTH_NUM", *PAIR, *SALE_MEASURES, *STOCK]
    return joined.select([F.col(name).alias(name) for name in names])


def fan_out_week_end(base: DataFrame, week_end_day: int = 6) -> DataFrame:
    week_end = base.where(F.col("DAY_OF_WK_NUM") == week_end_day)
    return totals(base).join(week_end.select(*GRAIN, "MNTH_NUM", *STOCK), GRAIN)


def fan_out_fact(sales, calendar, inventory, week_end_day: int = 6) -> DataFrame:
    base = fan_out_base(sales, calendar, inventory)
    flags = low_stock(base).select(*GRAIN, "LOW_STOCK_FLG")
    return fan_out_week_end(base, week_end_day).join(flags, GRAIN).select(FACT)
