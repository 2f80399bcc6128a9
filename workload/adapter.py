"""The five retail tables derived whole from the driver's tables.

``lineitem`` gives the sales, its distinct ship dates the calendar and its
distinct (date, supplier, part) the inventory; ``supplier`` and ``part`` give
the store and product dimensions. ``oracle.VIEWS`` states the same in SQL.

The operators take these tables as given inputs, so each is written once per
application to the shared folder, as Parquet in several files, and read from
there. The driver's single-file tables would be read by one task.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfweek.sinks.scratch import scratch_folder

SALES = """
SELECT l_orderkey * 10 + l_linenumber AS trans_id,
       l_partkey AS prod_key,
       l_suppkey AS store_key,
       CAST(l_shipdate AS DATE) AS trans_dt,
       l_linenumber AS trans_time,
       CAST(l_quantity AS DECIMAL(18,2)) AS sales_qty,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_price,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_amt,
       CAST(l_discount AS DECIMAL(18,2)) AS discount,
       CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
         AS sales_cost,
       CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS sales_mgrn,
       CAST(l_tax AS DECIMAL(18,2)) AS ship_cost
FROM {lineitem}
"""

CALENDAR = """
SELECT d AS cal_dt,
       'ISO' AS cal_type_desc,
       dayofweek(d) - 1 AS day_of_wk_num,
       date_format(d, 'EEEE') AS day_of_wk_desc,
       CAST(extract(YEAROFWEEK FROM d) AS INT) AS yr_num,
       weekofyear(d) AS wk_num,
       CAST(extract(YEAROFWEEK FROM d) * 100 + weekofyear(d) AS INT) AS yr_wk_num,
       month(d) AS mnth_num,
       year(d) * 100 + month(d) AS yr_mnth_num,
       quarter(d) AS qtr_num,
       year(d) * 10 + quarter(d) AS yr_qtr_num
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM {lineitem})
"""

INVENTORY = """
SELECT d AS cal_dt, s AS store_key, p AS prod_key,
       CAST((s * 31 + p * 17 + day(d)) % 40 AS DECIMAL(18,2)) AS inventory_on_hand_qty,
       CAST((s * 13 + p * 7 + day(d)) % 25 AS DECIMAL(18,2)) AS inventory_on_order_qty,
       CASE WHEN (s * 31 + p * 17 + day(d)) % 40 < 5 THEN 1 ELSE 0 END AS out_of_stock_flg,
       CAST((s + p + day(d)) % 7 AS DECIMAL(18,2)) AS waste_qty,
       (s + p) % 10 = 0 AS promotion_flg,
       date_add(d, 7) AS next_delivery_dt
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_suppkey AS s, l_partkey AS p
      FROM {lineitem})
"""

STORE = """
SELECT CAST(s_suppkey AS INT) AS store_key,
       lpad(CAST(s_suppkey AS STRING), 8, '0') AS store_num,
       s_name AS store_desc,
       concat(CAST(s_suppkey AS STRING), ' Main Street, "', n_name, '"') AS addr,
       concat('City ', CAST(s_nationkey AS STRING)) AS city,
       r_name AS region,
       lpad(CAST(s_nationkey AS STRING), 2, '0') AS cntry_cd,
       n_name AS cntry_nm,
       lpad(CAST(s_suppkey * 37 % 100000 AS STRING), 5, '0') AS postal_zip_cd,
       r_name AS prov_state_desc,
       substr(r_name, 1, 2) AS prov_state_cd,
       substr(n_name, 1, 1) AS store_type_cd,
       n_name AS store_type_desc,
       s_suppkey % 2 = 0 AS frnchs_flg,
       CAST(s_acctbal AS DECIMAL(19,3)) AS store_size,
       s_nationkey AS market_key,
       n_name AS market_name,
       n_regionkey AS submarket_key,
       r_name AS submarket_name,
       CAST(s_suppkey % 90 AS DECIMAL(19,6)) AS latitude,
       CAST(s_suppkey % 180 AS DECIMAL(19,6)) AS longitude
FROM {supplier}
JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

PRODUCT = """
SELECT CAST(p_partkey AS INT) AS prod_key,
       p_name AS prod_name,
       CAST(p_size AS DECIMAL(18,2)) AS vol,
       CAST(p_retailprice AS DECIMAL(18,2)) AS wgt,
       p_brand AS brand_name,
       p_size % 3 AS status_code,
       concat('status ', CAST(p_size % 3 AS STRING)) AS status_code_name,
       p_size AS category_key,
       p_type AS category_name,
       p_size % 10 AS subcategory_key,
       concat(p_brand, ' ', p_type) AS subcategory_name
FROM {part}
"""

DEFINITIONS = {
    "sales": SALES,
    "calendar": CALENDAR,
    "inventory": INVENTORY,
    "store": STORE,
    "product": PRODUCT,
}
INPUTS = ("lineitem", "supplier", "part", "nation", "region")


_written: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    query = DEFINITIONS[name]
    used = [i for i in INPUTS if "{" + i + "}" in query]
    return spark.sql(query, **{i: spark.read.parquet(f"{sf_dir}/{i}.parquet") for i in used})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_folder(spark, f"input-{name}")
        rows = derive(spark, sf_dir, name)
        if name == "sales":
            cores = spark.sparkContext.defaultParallelism
            lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
            if lines.rdd.getNumPartitions() < cores:
                rows = rows.repartition(cores)
        rows.write.option("compression", "zstd").parquet(path)
        _written[key] = path, rows.schema
    path, schema = _written[key]
    return spark.read.schema(schema).parquet(path)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, name) for name in names]


def as_declared(df: DataFrame, schema) -> DataFrame:
    """The table with its published column types, as an export would hold it."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
