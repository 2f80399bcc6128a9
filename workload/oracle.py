"""Independent SQL for every registered query, in DuckDB's dialect.

The SQL follows the definitions literally: all joins fan out as written and the
metrics are grouped from the joined rows. Decimals are compared as doubles,
dates as text and integers as BIGINT.
"""

VIEWS = """
sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS trans_id, l_partkey AS prod_key,
         l_suppkey AS store_key, CAST(l_shipdate AS DATE) AS trans_dt,
         l_linenumber AS trans_time,
         CAST(l_quantity AS DECIMAL(18,2)) AS sales_qty,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_price,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_amt,
         CAST(l_discount AS DECIMAL(18,2)) AS discount,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
           AS sales_cost,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS sales_mgrn,
         CAST(l_tax AS DECIMAL(18,2)) AS ship_cost
  FROM lineitem),
calendar AS (
  SELECT d AS cal_dt, 'ISO' AS cal_type_desc, dayofweek(d) AS day_of_wk_num,
         dayname(d) AS day_of_wk_desc, isoyear(d) AS yr_num, weekofyear(d) AS wk_num,
         isoyear(d) * 100 + weekofyear(d) AS yr_wk_num, month(d) AS mnth_num,
         year(d) * 100 + month(d) AS yr_mnth_num, quarter(d) AS qtr_num,
         year(d) * 10 + quarter(d) AS yr_qtr_num
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)),
inventory AS (
  SELECT d AS cal_dt, s AS store_key, p AS prod_key,
         CAST((s * 31 + p * 17 + day(d)) % 40 AS DECIMAL(18,2)) AS inventory_on_hand_qty,
         CAST((s * 13 + p * 7 + day(d)) % 25 AS DECIMAL(18,2)) AS inventory_on_order_qty,
         CASE WHEN (s * 31 + p * 17 + day(d)) % 40 < 5 THEN 1 ELSE 0 END AS out_of_stock_flg,
         CAST((s + p + day(d)) % 7 AS DECIMAL(18,2)) AS waste_qty,
         (s + p) % 10 = 0 AS promotion_flg,
         CAST(d + INTERVAL 7 DAY AS DATE) AS next_delivery_dt
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_suppkey AS s, l_partkey AS p
        FROM lineitem)),
store AS (
  SELECT s_suppkey AS store_key, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS store_num,
         s_name AS store_desc,
         CAST(s_suppkey AS VARCHAR) || ' Main Street, "' || n_name || '"' AS addr,
         'City ' || CAST(s_nationkey AS VARCHAR) AS city, r_name AS region,
         lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS cntry_cd, n_name AS cntry_nm,
         lpad(CAST(s_suppkey * 37 % 100000 AS VARCHAR), 5, '0') AS postal_zip_cd,
         r_name AS prov_state_desc, substr(r_name, 1, 2) AS prov_state_cd,
         substr(n_name, 1, 1) AS store_type_cd, n_name AS store_type_desc,
         s_suppkey % 2 = 0 AS frnchs_flg, CAST(s_acctbal AS DECIMAL(19,3)) AS store_size,
         s_nationkey AS market_key, n_name AS market_name, n_regionkey AS submarket_key,
         r_name AS submarket_name, CAST(s_suppkey % 90 AS DECIMAL(19,6)) AS latitude,
         CAST(s_suppkey % 180 AS DECIMAL(19,6)) AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
product AS (
  SELECT p_partkey AS prod_key, p_name AS prod_name, CAST(p_size AS DECIMAL(18,2)) AS vol,
         CAST(p_retailprice AS DECIMAL(18,2)) AS wgt, p_brand AS brand_name,
         p_size % 3 AS status_code, 'status ' || CAST(p_size % 3 AS VARCHAR) AS status_code_name,
         p_size AS category_key, p_type AS category_name, p_size % 10 AS subcategory_key,
         p_brand || ' ' || p_type AS subcategory_name
  FROM part)
"""

BASE = """
base AS (
  SELECT c.yr_num, c.wk_num, c.day_of_wk_num, c.mnth_num, s.store_key, s.prod_key,
         s.sales_qty, s.sales_amt, CAST(s.sales_cost AS {cost}) AS sales_cost,
         i.inventory_on_hand_qty, i.inventory_on_order_qty, i.out_of_stock_flg
  FROM sales s JOIN calendar c ON s.trans_dt = c.cal_dt
  JOIN inventory i ON s.store_key = i.store_key AND s.prod_key = i.prod_key {dated})
"""

# Halves are rounded up in whole numbers, as DuckDB divides decimals as doubles.
METRICS = """
  CAST(sum(sales_qty) AS DOUBLE) AS TOTAL_SALES_QTY,
  CAST(sum(sales_amt) AS DOUBLE) AS TOTAL_SALES_AMT,
  CAST(round(sum(sales_cost), 3) AS DOUBLE) AS TOTAL_COST_WEEK,
  CAST((2000 * CAST(sum(sales_amt) * 100 AS HUGEINT) + CAST(sum(sales_qty) * 100 AS HUGEINT))
    // (2 * nullif(CAST(sum(sales_qty) * 100 AS HUGEINT), 0)) AS DOUBLE) / 1000
    AS AVG_SALES_PRICE,
  round(CAST(sum(out_of_stock_flg) AS DOUBLE) / 7 * 100, 3) AS PERCENTAGE_STORE_IN_STOCK,
  CAST(sum(out_of_stock_flg) AS BIGINT) AS NO_STOCK_INSTANCE
"""

KEYS = """
  CAST({0}yr_num AS BIGINT) AS YR_NUM, CAST({0}wk_num AS BIGINT) AS WK_NUM,
  {0}store_key AS STORE_KEY, {0}prod_key AS PROD_KEY
"""

LINE = """
  CAST(sales_qty AS DOUBLE) AS SALES_QTY, CAST(sales_amt AS DOUBLE) AS SALES_AMT,
  CAST(sales_cost AS DOUBLE) AS SALES_COST
"""

STOCK = """
  CAST({0}inventory_on_hand_qty AS DOUBLE) AS INVENTORY_ON_HAND_QTY,
  CAST({0}inventory_on_order_qty AS DOUBLE) AS INVENTORY_ON_ORDER_QTY,
  CAST({0}out_of_stock_flg AS BIGINT) AS OUT_OF_STOCK_FLG
"""

LOW = "CASE WHEN inventory_on_hand_qty < sales_qty THEN 1 ELSE 0 END"
DATED = "AND s.trans_dt = i.cal_dt"
METRIC_NAMES = (
    "a.TOTAL_SALES_QTY, a.TOTAL_SALES_AMT, a.TOTAL_COST_WEEK, a.AVG_SALES_PRICE, "
    "a.PERCENTAGE_STORE_IN_STOCK, a.NO_STOCK_INSTANCE"
)


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join([VIEWS, *parts]) + "\n" + select


def _base(dated: str = "", cost: str = "DECIMAL(24,4)") -> str:
    return BASE.format(dated=dated, cost=cost)


def _sales_calendar() -> str:
    return _with(
        select=f"""
SELECT CAST(yr_num AS BIGINT) AS YR_NUM, CAST(wk_num AS BIGINT) AS WK_NUM,
       CAST(day_of_wk_num AS BIGINT) AS DAY_OF_WK_NUM, CAST(mnth_num AS BIGINT) AS MNTH_NUM,
       store_key AS STORE_KEY, prod_key AS PROD_KEY, {LINE}
FROM sales JOIN calendar ON trans_dt = cal_dt"""
    )


def _base_join(dated: str = "") -> str:
    return _with(
        _base(dated),
        select=f"""
SELECT {KEYS.format("")}, CAST(day_of_wk_num AS BIGINT) AS DAY_OF_WK_NUM,
       CAST(mnth_num AS BIGINT) AS MNTH_NUM, {LINE}, {STOCK.format("")}
FROM base""",
    )


def _low_stock() -> str:
    return _with(
        _base(),
        select=f"""
SELECT {KEYS.format("")}, CAST(inventory_on_hand_qty AS DOUBLE) AS INVENTORY_ON_HAND_QTY,
       CAST(sales_qty AS DOUBLE) AS SALES_QTY, CAST({LOW} AS BIGINT) AS LOW_STOCK_FLG
FROM base""",
    )


def _totals(dated: str = "") -> str:
    return _with(
        _base(dated),
        select=f"""
SELECT {KEYS.format("")}, {METRICS} FROM base
GROUP BY yr_num, wk_num, store_key, prod_key""",
    )


def _fact(stage: str, cost: str = "DECIMAL(24,4)", counted: bool = False) -> str:
    """The fact by three-way fan-out; ``stage`` is week_end, low or fact."""
    totals = f"totals AS (SELECT {KEYS.format('')}, {METRICS} FROM base GROUP BY ALL)"
    week_end = f"""
week_end AS (
  SELECT a.*, CAST(j.mnth_num AS BIGINT) AS MNTH_NUM, {STOCK.format("j.")}
  FROM base j JOIN totals a
    ON j.store_key = a.STORE_KEY AND j.prod_key = a.PROD_KEY
   AND j.yr_num = a.YR_NUM AND j.wk_num = a.WK_NUM
  WHERE j.day_of_wk_num = 6)"""
    if stage == "week_end":
        return _with(_base(cost=cost), totals, week_end, select="SELECT * FROM week_end")
    low = f"""
low AS (
  SELECT a.*, CAST({LOW.replace("inventory", "l.inventory", 1)} AS BIGINT) AS LOW_STOCK_FLG
  FROM base l JOIN week_end a
    ON l.store_key = a.STORE_KEY AND l.prod_key = a.PROD_KEY
   AND l.yr_num = a.YR_NUM AND l.wk_num = a.WK_NUM)"""
    columns = f"""a.YR_NUM, a.MNTH_NUM, a.WK_NUM, a.STORE_KEY, a.PROD_KEY, {METRIC_NAMES},
  a.INVENTORY_ON_HAND_QTY, a.INVENTORY_ON_ORDER_QTY, a.OUT_OF_STOCK_FLG, a.LOW_STOCK_FLG"""
    select = "SELECT * FROM low"
    if stage == "fact":
        select = f"SELECT {columns} FROM low a"
    if counted:
        select = f"SELECT {columns}, count(*) AS ROW_COPIES FROM low a GROUP BY ALL"
    return _with(_base(cost=cost), totals, week_end, low, select=select)


def summary_select(week_end_day: int = 6) -> str:
    stock = ", ".join(
        f"CAST(max(CASE WHEN day_of_wk_num = {week_end_day} THEN {name} END) AS {kind}) "
        f"AS {name.upper()}"
        for name, kind in (
            ("inventory_on_hand_qty", "DOUBLE"),
            ("inventory_on_order_qty", "DOUBLE"),
            ("out_of_stock_flg", "BIGINT"),
        )
    )
    return f"""
SELECT {KEYS.format("")}, {METRICS}, {stock}, CAST(max({LOW}) AS BIGINT) AS LOW_STOCK_FLG
FROM base GROUP BY yr_num, wk_num, store_key, prod_key"""


def _summary(select: str = "SELECT * FROM summary") -> str:
    return _with(
        _base(DATED),
        f"summary AS ({summary_select()})",
        f"sunday AS ({summary_select(0)})",
        select=select,
    )


SALES_ROWS = """
  trans_id, prod_key, store_key, CAST(trans_dt AS VARCHAR) AS trans_dt,
  CAST(trans_time AS BIGINT) AS trans_time, CAST(sales_qty AS DOUBLE) AS sales_qty,
  CAST(sales_price AS DOUBLE) AS sales_price, CAST(sales_amt AS DOUBLE) AS sales_amt,
  CAST(discount AS DOUBLE) AS discount,
  CAST(CAST(sales_cost AS DECIMAL(18,2)) AS DOUBLE) AS sales_cost,
  CAST(CAST(sales_mgrn AS DECIMAL(18,2)) AS DOUBLE) AS sales_mgrn,
  CAST(ship_cost AS DOUBLE) AS ship_cost
"""

INVENTORY_ROWS = f"""
  CAST(cal_dt AS VARCHAR) AS cal_dt, store_key, prod_key,
  {STOCK.format("").replace("AS INVENTORY_ON_HAND_QTY", "AS inventory_on_hand_qty")
   .replace("AS INVENTORY_ON_ORDER_QTY", "AS inventory_on_order_qty")
   .replace("AS OUT_OF_STOCK_FLG", "AS out_of_stock_flg")},
  CAST(waste_qty AS DOUBLE) AS waste_qty, promotion_flg,
  CAST(next_delivery_dt AS VARCHAR) AS next_delivery_dt
"""

STORE_ROWS = """
  store_key, {num} AS store_num, store_desc, addr, city, region, {cntry} AS cntry_cd, cntry_nm,
  {zip} AS postal_zip_cd, prov_state_desc, prov_state_cd, store_type_cd, store_type_desc,
  frnchs_flg, CAST(store_size AS DOUBLE) AS store_size, CAST(market_key AS BIGINT) AS market_key,
  market_name, CAST(submarket_key AS BIGINT) AS submarket_key, submarket_name,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
"""

TEXT_CODES = {"num": "store_num", "cntry": "cntry_cd", "zip": "postal_zip_cd"}
NUMBER_CODES = {k: f"CAST({v} AS BIGINT)" for k, v in TEXT_CODES.items()}

RUN_DATE = "2001-11-05"
# The dense queries fold the keys onto this many stores and products.
DENSE_STORES, DENSE_PRODUCTS = 20, 100

PRODUCT_ROWS = """
  prod_key, prod_name, CAST(vol AS DOUBLE) AS vol, CAST(wgt AS DOUBLE) AS wgt, brand_name,
  CAST(status_code AS BIGINT) AS status_code, status_code_name,
  CAST(category_key AS BIGINT) AS category_key, category_name,
  CAST(subcategory_key AS BIGINT) AS subcategory_key, subcategory_name
"""

CALENDAR_ROWS = """
  CAST(cal_dt AS VARCHAR) AS cal_dt, cal_type_desc, CAST(day_of_wk_num AS BIGINT) AS day_of_wk_num,
  day_of_wk_desc, CAST(yr_num AS BIGINT) AS yr_num, CAST(wk_num AS BIGINT) AS wk_num,
  CAST(yr_wk_num AS BIGINT) AS yr_wk_num, CAST(mnth_num AS BIGINT) AS mnth_num,
  CAST(yr_mnth_num AS BIGINT) AS yr_mnth_num, CAST(qtr_num AS BIGINT) AS qtr_num,
  CAST(yr_qtr_num AS BIGINT) AS yr_qtr_num
"""

# Days out of stock, whether or not something was sold on them.
IN_STOCK = f"""
SELECT f.YR_NUM, f.WK_NUM, f.STORE_KEY, f.PROD_KEY, f.PERCENTAGE_STORE_IN_STOCK,
       round(100 - coalesce(d.n, 0) / 7 * 100, 3) AS IN_STOCK_PCT
FROM summary f LEFT JOIN (
  SELECT yr_num, wk_num, store_key, prod_key, CAST(count(DISTINCT i.cal_dt) AS DOUBLE) AS n
  FROM inventory i JOIN calendar c ON i.cal_dt = c.cal_dt
  WHERE out_of_stock_flg = 1 GROUP BY ALL) d
ON f.YR_NUM = d.yr_num AND f.WK_NUM = d.wk_num AND f.STORE_KEY = d.store_key
   AND f.PROD_KEY = d.prod_key"""


def _dense(sql: str) -> str:
    """The same over folded keys: the folded tables take the names of the plain ones."""
    fold = f"""* REPLACE (store_key % {DENSE_STORES} AS store_key, prod_key % {DENSE_PRODUCTS} AS prod_key)"""
    folded = VIEWS.replace("sales AS (", "all_sales AS (").replace("inventory AS (", "all_inventory AS (")
    more = f""",
sales AS (SELECT {fold} FROM all_sales), inventory AS (SELECT {fold} FROM all_inventory)
"""
    return sql.replace(VIEWS, folded + more)


def oracle_sql() -> dict[str, str]:
    months = """
months AS (SELECT DISTINCT CAST(date_trunc('month', cal_dt + later) AS DATE) AS run_date
           FROM calendar, (VALUES (0), (30), (60)) AS t(later)),
required AS (SELECT 'sales' AS table_name, run_date FROM months
             UNION ALL SELECT 'inventory', run_date FROM months),
landed AS (SELECT DISTINCT 'sales' AS table_name,
                  CAST(date_trunc('month', trans_dt) AS DATE) AS run_date FROM sales
           UNION ALL SELECT DISTINCT 'inventory', CAST(date_trunc('month', cal_dt) AS DATE)
           FROM inventory)
"""
    loaded = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, "
        f"CAST({total} AS DOUBLE) AS total FROM {name}"
        for name, total in (
            ("sales", "sum(sales_amt)"),
            ("calendar", "sum(yr_wk_num)"),
            ("inventory", "sum(inventory_on_hand_qty)"),
            ("store", "sum(store_size)"),
            ("product", "sum(wgt)"),
        )
    )
    return {
        "sales_calendar_join": _sales_calendar(),
        "base_join": _base_join(),
        "low_stock": _low_stock(),
        "weekly_totals": _totals(),
        "week_end_stock": _fact("week_end"),
        "low_stock_join": _fact("low"),
        "weekly_fact": _fact("fact"),
        "weekly_fact_counted": _fact("fact", counted=True),
        "base_join_dated": _base_join(DATED),
        "weekly_totals_dated": _totals(DATED),
        "weekly_summary": _summary(),
        "in_stock_pct": _summary(IN_STOCK),
        "fact_enriched": _summary(
            """SELECT f.*, s.store_desc, s.region, s.market_name,
       p.prod_name, p.brand_name, p.category_name
FROM summary f LEFT JOIN store s ON f.STORE_KEY = s.store_key
LEFT JOIN product p ON f.PROD_KEY = p.prod_key"""
        ),
        "duplicate_sales": _with(
            select="SELECT trans_id, count(*) AS n_rows FROM sales GROUP BY 1 HAVING count(*) > 1"
        ),
        "duplicate_calendar": """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS cal_dt, count(*) AS n_rows
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "duplicate_inventory": """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS cal_dt, l_suppkey AS store_key,
       l_partkey AS prod_key, count(*) AS n_rows
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "dropped_sales": _with(
            "moved AS (SELECT * REPLACE (CAST(trans_dt + 30 AS DATE) AS trans_dt, "
            "prod_key + 1 AS prod_key) FROM sales)",
            select=f"""
SELECT {SALES_ROWS}, 'no calendar day' AS reason FROM moved s WHERE NOT EXISTS
  (SELECT 1 FROM calendar c WHERE c.cal_dt = s.trans_dt)
UNION ALL
SELECT {SALES_ROWS}, 'no inventory' AS reason FROM moved s WHERE NOT EXISTS
  (SELECT 1 FROM inventory i WHERE i.store_key = s.store_key AND i.prod_key = s.prod_key)"""
        ),
        "csv_scan_typed": _with(
            select=f"SELECT {STORE_ROWS.format(**TEXT_CODES)} FROM store"
        ),
        "csv_scan_inferred": _with(
            select=f"SELECT {STORE_ROWS.format(**NUMBER_CODES)} FROM store"
        ),
        "gzip_csv_scan": _with(select=f"SELECT {INVENTORY_ROWS} FROM inventory"),
        "load_tables": _with(select=loaded),
        "landing_extract": _with(select=f"SELECT {SALES_ROWS} FROM sales"),
        "landed_tables": _with(
            months,
            select="SELECT table_name, CAST(run_date AS VARCHAR) AS run_date FROM landed",
        ),
        "missing_inputs": _with(
            months,
            select="SELECT table_name, CAST(run_date AS VARCHAR) AS run_date FROM required "
            "EXCEPT SELECT table_name, CAST(run_date AS VARCHAR) FROM landed",
        ),
        "fact_parquet_roundtrip": _summary(),
        "fact_sorted": _summary(),
        "static_overwrite": _summary("SELECT * FROM sunday WHERE YR_NUM = 1996"),
        "dynamic_overwrite": _summary(
            """SELECT * FROM summary WHERE YR_NUM <> 1996
UNION ALL SELECT * FROM sunday WHERE YR_NUM = 1996"""
        ),
        "catalog_repair": _summary("SELECT * FROM summary WHERE YR_NUM >= 1996"),
        "dim_csv_snapshot": _with(
            select=f"SELECT {STORE_ROWS.format(**TEXT_CODES)}, '{RUN_DATE}' AS date FROM store"
        ),
        "landing_files": _with(select=f"SELECT {SALES_ROWS} FROM sales"),
        "nightly_job": _fact("fact", cost="DECIMAL(18,2)"),
        "nightly_counted": _fact("fact", cost="DECIMAL(18,2)", counted=True),
        "nightly_summary": _with(
            _base(DATED, "DECIMAL(18,2)"), f"summary AS ({summary_select()})",
            select="SELECT * FROM summary",
        ),
        "nightly_store": _with(
            select=f"SELECT {STORE_ROWS.format(**TEXT_CODES)}, '{RUN_DATE}' AS date FROM store"
        ),
        "nightly_product": _with(select=f"SELECT {PRODUCT_ROWS}, '{RUN_DATE}' AS date FROM product"),
        "nightly_calendar": _with(select=f"SELECT {CALENDAR_ROWS}, '{RUN_DATE}' AS date FROM calendar"),
        "published_versions": _summary(
            """SELECT *, CAST(1 AS BIGINT) AS VERSION FROM sunday
UNION ALL SELECT *, 2 FROM sunday WHERE YR_NUM < 1996
UNION ALL SELECT *, 2 FROM summary WHERE YR_NUM >= 1996"""
        ),
        "catalog_published": _summary("SELECT * FROM summary WHERE YR_NUM >= 1996"),
        "nightly_incremental": _fact("fact", cost="DECIMAL(18,2)", counted=True),
        "nightly_incremental_summary": _with(
            _base(DATED, "DECIMAL(18,2)"), f"summary AS ({summary_select()})",
            select="SELECT * FROM summary",
        ),
        "manifest_gate": _with(
            select="""
SELECT 'sales' AS table_name, 'truncated' AS problem, NULL AS rows_of, count(*) AS n_rows FROM sales
UNION ALL SELECT 'inventory', 'copy', 'inventory', count(*) FROM inventory
UNION ALL SELECT 'store', 'swapped', 'product', count(*) FROM store
UNION ALL SELECT 'product', 'swapped', 'store', count(*) FROM product
UNION ALL SELECT 'calendar', 'missing', NULL, count(*) FROM calendar"""
        ),
        "quarantined_sales": _with(
            select="""
SELECT CAST(trans_id AS BIGINT) AS trans_id, CASE trans_id % 1000
         WHEN 13 THEN 'sales_qty' WHEN 21 THEN 'trans_dt' WHEN 45 THEN 'trans_dt,sales_qty'
         WHEN 37 THEN 'wrong number of fields' ELSE 'kept' END AS outcome
FROM sales"""
        ),
        "base_join_hot": _base_join(),
        "base_join_dense": _dense(_base_join()),
        "weekly_totals_dense": _dense(_totals()),
        "weekly_fact_counted_hot": _fact("fact", counted=True),
        "weekly_fact_counted_dense": _dense(_fact("fact", counted=True)),
    }
