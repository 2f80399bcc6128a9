"""Column expressions of the weekly metrics.

All of them are built-in functions, so they stay inside whole-stage codegen,
and all are safe under ANSI mode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amount and quantity totals are narrowed to this type before they are divided.
# Spark gives decimal(28,2)/decimal(28,2) ten fractional digits; wider operands
# would leave six, too few to round a ratio to three digits correctly.
RATIO_OPERAND = "decimal(28,2)"


def low_stock_flag(on_hand: Column, qty: Column) -> Column:
    """1 where less is on hand than was sold; 0 otherwise, also for NULLs."""
    return F.when(on_hand < qty, 1).otherwise(0)


def total(value: Column) -> Column:
    return value.cast("decimal(38,2)")


def total_cost(cost: Column) -> Column:
    return F.round(cost, 3).cast("decimal(38,3)")


def average_price(amount: Column, qty: Column) -> Column:
    """Ratio of the two totals, NULL for a zero quantity."""
    ratio = F.try_divide(amount.cast(RATIO_OPERAND), qty.cast(RATIO_OPERAND))
    return F.round(ratio, 3).cast("decimal(38,3)")


def out_of_stock_pct(instances: Column) -> Column:
    """Out-of-stock instances as a percentage of a seven-day week."""
    return F.round(instances / 7 * 100, 3)


def weekly_metrics(qty: Column, amount: Column, cost: Column, outs: Column) -> dict[str, Column]:
    """The six metrics of a week from its summed quantity, amount, cost and outs."""
    return {
        "TOTAL_SALES_QTY": total(qty),
        "TOTAL_SALES_AMT": total(amount),
        "TOTAL_COST_WEEK": total_cost(cost),
        "AVG_SALES_PRICE": average_price(amount, qty),
        "PERCENTAGE_STORE_IN_STOCK": out_of_stock_pct(outs),
        "NO_STOCK_INSTANCE": outs.cast("bigint"),
    }
