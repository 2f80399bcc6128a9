"""Column types of the five source tables and the names used in the fact.

Fixed values: names and types follow the published table definitions, with
two deliberate changes. Money and quantities are DECIMAL(18,2), which leaves
``sum`` and division room to stay exact, and ``day_of_wk_num`` is an INT
because the week-end filter compares it with a number.
"""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructType,
)

INT, STRING, DATE, BOOLEAN = IntegerType(), StringType(), DateType(), BooleanType()
MONEY, SIZE, DEGREES = DecimalType(18, 2), DecimalType(19, 3), DecimalType(19, 6)


def _table(**columns: DataType) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


STORE = _table(
    store_key=INT,
    store_num=STRING,
    store_desc=STRING,
    addr=STRING,
    city=STRING,
    region=STRING,
    cntry_cd=STRING,
    cntry_nm=STRING,
    postal_zip_cd=STRING,
    prov_state_desc=STRING,
    prov_state_cd=STRING,
    store_type_cd=STRING,
    store_type_desc=STRING,
    frnchs_flg=BOOLEAN,
    store_size=SIZE,
    market_key=INT,
    market_name=STRING,
    submarket_key=INT,
    submarket_name=STRING,
    latitude=DEGREES,
    longitude=DEGREES,
)

SALES = _table(
    trans_id=INT,
    prod_key=INT,
    store_key=INT,
    trans_dt=DATE,
    trans_time=INT,
    sales_qty=MONEY,
    sales_price=MONEY,
    sales_amt=MONEY,
    discount=MONEY,
    sales_cost=MONEY,
    sales_mgrn=MONEY,
    ship_cost=MONEY,
)

CALENDAR = _table(
    cal_dt=DATE,
    cal_type_desc=STRING,
    day_of_wk_num=INT,
    day_of_wk_desc=STRING,
    yr_num=INT,
    wk_num=INT,
    yr_wk_num=INT,
    mnth_num=INT,
    yr_mnth_num=INT,
    qtr_num=INT,
    yr_qtr_num=INT,
)

PRODUCT = _table(
    prod_key=INT,
    prod_name=STRING,
    vol=MONEY,
    wgt=MONEY,
    brand_name=STRING,
    status_code=INT,
    status_code_name=STRING,
    category_key=INT,
    category_name=STRING,
    subcategory_key=INT,
    subcategory_name=STRING,
)

INVENTORY = _table(
    cal_dt=DATE,
    store_key=INT,
    prod_key=INT,
    inventory_on_hand_qty=MONEY,
    inventory_on_order_qty=MONEY,
    out_of_stock_flg=INT,
    waste_qty=MONEY,
    promotion_flg=BOOLEAN,
    next_delivery_dt=DATE,
)

TABLES = {
    "sales": SALES,
    "calendar": CALENDAR,
    "inventory": INVENTORY,
    "store": STORE,
    "product": PRODUCT,
}

PAIR = ["STORE_KEY", "PROD_KEY"]
GRAIN = ["YR_NUM", "WK_NUM", *PAIR]
SALE_MEASURES = ["SALES_QTY", "SALES_AMT", "SALES_COST"]
STOCK = ["INVENTORY_ON_HAND_QTY", "INVENTORY_ON_ORDER_QTY", "OUT_OF_STOCK_FLG"]
METRICS = [
    "TOTAL_SALES_QTY",
    "TOTAL_SALES_AMT",
    "TOTAL_COST_WEEK",
    "AVG_SALES_PRICE",
    "PERCENTAGE_STORE_IN_STOCK",
    "NO_STOCK_INSTANCE",
]
FACT = ["YR_NUM", "MNTH_NUM", "WK_NUM", *PAIR, *METRICS, *STOCK, "LOW_STOCK_FLG"]
FACT_PARTITIONS = ["YR_NUM", "WK_NUM"]
