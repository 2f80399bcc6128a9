"""The hand-checked micro tables and helpers to build and compare frames."""

from collections import Counter
from datetime import date
from decimal import Decimal

from shelfweek.schemas import CALENDAR, INVENTORY, SALES


def rows(spark, schema, *records):
    """A frame of ``schema`` from partial records; absent columns are NULL."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def day(text):
    return None if text is None else date.fromisoformat(text)


def money(text):
    return None if text is None else Decimal(text)


def sale(trans_id, prod, store, on, qty, amt, cost):
    return {
        "trans_id": trans_id,
        "prod_key": prod,
        "store_key": store,
        "trans_dt": day(on),
        "sales_qty": money(qty),
        "sales_amt": money(amt),
        "sales_cost": money(cost),
    }


def cal(on, dow, year, week, month):
    return {
        "cal_dt": day(on),
        "day_of_wk_num": dow,
        "yr_num": year,
        "wk_num": week,
        "mnth_num": month,
    }


def stock(on, store, prod, on_hand, on_order, out):
    return {
        "cal_dt": day(on),
        "store_key": store,
        "prod_key": prod,
        "inventory_on_hand_qty": money(on_hand),
        "inventory_on_order_qty": money(on_order),
        "out_of_stock_flg": out,
    }


def micro(spark):
    sales = rows(
        spark,
        SALES,
        sale(1, 10, 1, "2023-01-02", "5", "10", "6"),
        sale(2, 10, 1, "2023-01-07", "3", "6", "3.60"),
        sale(3, 11, 1, "2023-01-03", "4", "8", "5"),
        sale(4, 10, 2, "2023-01-14", "0", "0", "0"),
        sale(5, 11, 2, "2023-01-07", "7", "21", "9"),
        sale(6, 10, 3, "2023-02-01", "1", "2", "1"),
        sale(7, 11, 3, "2023-01-07", "2", "9", "4"),
        sale(8, 10, 3, None, "1", "2", "1"),
    )
    calendar = rows(
        spark,
        CALENDAR,
        cal("2023-01-02", 1, 2023, 1, 1),
        cal("2023-01-03", 2, 2023, 1, 1),
        cal("2023-01-07", 6, 2023, 1, 1),
        cal("2023-01-14", 6, 2023, 2, 1),
    )
    inventory = rows(
        spark,
        INVENTORY,
        stock("2023-01-02", 1, 10, "4", "20", 0),
        stock("2023-01-07", 1, 10, "10", "0", 1),
        stock("2023-01-03", 1, 11, "100", "0", 0),
        stock("2023-01-14", 2, 10, "0", "5", 1),
        stock("2023-01-07", 3, 11, None, None, None),
        stock("2023-01-07", 3, 10, "6", "0", 0),
    )
    return sales, calendar, inventory


def bag(df, columns=None):
    """The rows of ``df`` with their numbers of copies; decimals as floats."""
    names = sorted(df.columns) if columns is None else columns
    return Counter(
        tuple(float(v) if isinstance(v, Decimal) else v for v in row)
        for row in df.select(*names).collect()
    )
