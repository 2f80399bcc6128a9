import pytest
from pyspark.sql import functions as F

from shelfweek.operators import counted, joins, skew
from shelfweek.operators.skew import _bucket, checked_broadcast, hot_cells, skew_join
from shelfweek.schemas import CALENDAR, INVENTORY, SALES
from tests.fixtures import bag, cal, rows, sale, stock


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows of either side, and more, hold one key."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).cast("int").alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 90).alias("k"),
        F.col("id").alias("r"),
    )
    return left, right.union(spark.sql("SELECT CAST(NULL AS BIGINT), CAST(-1 AS BIGINT)"))


def test_hot_cells_find_the_large_key(sides):
    left, right = hot_cells(["k"], *sides, hot_rows=50)
    assert len(left) == 1 and len(right) == 1
    # The key types differ, the bucket must not.
    assert left.keys() == right.keys()
    assert next(iter(left.values())) > 10
    assert hot_cells(["k"], *sides) == [{}, {}]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("hot_rows", [1, 50])
def test_skew_join_equals_plain_join(sides, how, hot_rows):
    left, right = sides
    cells = hot_cells(["k"], left, right, hot_rows=hot_rows)
    assert all(cells)
    split = skew_join(left, right, ["k"], how, left_cells=cells[0], right_cells=cells[1])
    expected = left.join(right, "k", how)
    assert split.columns == expected.columns
    assert bag(split) == bag(expected)


def test_hot_key_is_spread_over_tasks(spark, sides):
    left, right = sides
    cells = hot_cells(["k"], left, right, hot_rows=50)
    rows = skew_join(left, right, ["k"], left_cells=cells[0], right_cells=cells[1])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = rows.filter("k = 7").rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(hot) > 100_000
    assert max(hot) < sum(hot) / 3


def rows_per_task(spark, frame):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return frame.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def one_pair(spark, n_sales, n_snapshots, distinct):
    """Many sales and snapshots of one pair, equal or all different."""
    amount = F.col("id").cast("decimal(18,2)") if distinct else F.lit(3).cast("decimal(18,2)")
    first = rows(spark, SALES, sale(1, 10, 1, "2023-01-02", "1", "2", "1")).first()
    sales = spark.range(n_sales).select(
        *[F.lit(first[f.name]).cast(f.dataType).alias(f.name) if f.name != "sales_amt" else amount.alias("sales_amt")
          for f in SALES]
    )
    held = rows(spark, INVENTORY, stock("2023-01-02", 1, 10, "4", "5", 0)).first()
    inventory = spark.range(n_snapshots).select(
        *[F.lit(held[f.name]).cast(f.dataType).alias(f.name) if f.name != "inventory_on_hand_qty" else
          amount.alias("inventory_on_hand_qty") for f in INVENTORY]
    )
    return sales, rows(spark, CALENDAR, cal("2023-01-02", 0, 2023, 1, 1)), inventory


@pytest.mark.parametrize("distinct", [False, True], ids=["equal", "distinct"])
def test_hot_pair_is_spread_even_with_equal_rows(spark, distinct):
    joined = joins.base_join(*one_pair(spark, 40_000, 5, distinct), hot_rows=1000, hot_product=20_000)
    tasks = rows_per_task(spark, joined)
    assert sum(tasks) == 200_000
    assert max(tasks) <= 2 * sum(tasks) / 8


def test_large_product_is_spread_under_default_settings(spark):
    """Neither side is large, what they join to is."""
    joined = joins.base_join(*one_pair(spark, 40_000, 500, False))
    tasks = rows_per_task(spark, joined)
    assert sum(tasks) == 20_000_000
    assert max(tasks) <= 2 * sum(tasks) / 8


def test_cells_bound_rows_and_products(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), "id").union(spark.range(50).select((F.col("id") + 2).cast("int"), "id"))
    right = spark.range(40).select(F.lit(1).alias("k"), "id")
    for rows_, product in ((100, None), (10_000, 400), (10_000, 10_000), (30, 900)):
        cells = hot_cells(["k"], left, right, hot_rows=rows_, hot_product=product)
        a, b = (next(iter(c.values()), 1) for c in cells)
        assert 1000 / a <= rows_ and 40 / b <= max(rows_, 40 if product is None else rows_)
        assert product is None or (1000 / a) * (40 / b) <= product
    assert hot_cells(["k"], left, right, hot_product=40_000) == [{}, {}]


def test_broadcasts_are_measured_in_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("x"))
    assert checked_broadcast(wide, 900_000) is None
    assert checked_broadcast(wide, 1_100_000) is not None
    assert checked_broadcast(wide.limit(0), 0) is not None


def test_cells_are_no_smaller_than_a_part_of_a_tasks_share(spark):
    """Limits far below what a task gets anyway would only copy rows more often."""
    left = spark.range(40_000).select((F.col("id") % 4).alias("k"), "id")
    for rows_, product in ((10, None), (10, 100)):
        cells = hot_cells(["k"], left, left, hot_rows=rows_, hot_product=product)
        for side in cells:
            assert len(side) == 4
            assert all(1 < n <= 10_000 * 32 * 8 / 40_000 + 1 for n in side.values())


def test_joined_rows_with_few_copies_are_not_shuffled(spark, monkeypatch):
    shuffled, unroll = [], counted.unroll
    monkeypatch.setattr(counted, "unroll", lambda rows: shuffled.append(rows) or unroll(rows))
    joined = joins.base_join(*one_pair(spark, 2_000, 500, True), hot_rows=100, hot_product=1000)
    assert joined.distinct().count() == joined.count() == 1_000_000
    assert shuffled[0].count() == 0


def test_joined_rows_with_some_hundred_copies_are_not_shuffled(spark, monkeypatch):
    sales, calendar, inventory = one_pair(spark, 200, 50, True)
    sales, inventory = (t.crossJoin(spark.range(10).select()) for t in (sales, inventory))
    shuffled, unroll = [], counted.unroll
    monkeypatch.setattr(counted, "unroll", lambda rows: shuffled.append(rows) or unroll(rows))
    joined = joins.base_join(sales, calendar, inventory, hot_rows=100, hot_product=1000)
    assert set(bag(joined).values()) == {100} and joined.count() == 1_000_000
    assert shuffled[0].count() == 0


def test_rows_are_shaped_before_they_are_repeated(spark):
    """Also those of cold pairs, and with rows that are cut into pieces."""
    sales, calendar, inventory = one_pair(spark, 300, 70, False)
    cold = rows(spark, SALES, sale(2, 11, 1, "2023-01-02", "2", "3", "1"))
    held = rows(spark, INVENTORY, stock("2023-01-02", 1, 11, "5", "0", 0))
    three = sales.union(cold), calendar, inventory.union(held)

    seen, limits = [], {"hot_rows": 100, "hot_product": 1000}

    def shape(frame):
        seen.append(frame)
        return frame.withColumn("SALES_AMT", F.col("SALES_AMT").cast("double"))

    shaped = joins.base_join(*three, **limits, shape=shape)
    assert dict(shaped.dtypes)["SALES_AMT"] == "double"
    assert sorted(bag(shaped).values()) == [1, 21_000]
    assert bag(shaped) == bag(joins.base_join(*three, **limits))
    assert sum(frame.count() for frame in seen) == 2


def test_hot_keys_are_counted_if_a_share_holds_them(spark):
    """A thousand pairs above both limits, each far below a task's share of them all."""
    left = spark.range(100_000).select((F.col("id") % 1000).alias("k"), "id")
    cells = hot_cells(["k"], left, left, hot_rows=50, hot_product=5_000)
    assert len({*cells[0], *cells[1]}) > 900
    assert max(*cells[0].values(), *cells[1].values(), 0) <= 2


def test_a_grid_of_one_cell_is_a_plain_join(spark, sides):
    left, right = sides
    whole = skew_join(left, right, ["k"], left_cells={1: 1}, right_cells={2: 1})
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert bag(whole) == bag(left.join(right, "k"))


def test_keys_are_counted_as_numbers(spark, sides):
    """Of another width too; other types are counted as text."""
    left, right = sides
    for a, b in ((left, right), (left.withColumn("k", F.col("k").cast("string")),) * 2):
        (large, *_), _ = hot_cells(["k"], a, b, hot_rows=50)
        assert large in {r[0] for r in a.filter("k = 7").select(_bucket(a, ["k"])).distinct().collect()}


def test_crowded_groups_are_not_counted_first(spark, monkeypatch):
    """More rows than a hot key's in every group: the same cells, without the first count."""
    left = spark.range(40_000).select((F.col("id") % 9_000).alias("k"), "id")
    found = hot_cells(["k"], left, left.limit(9_500), hot_rows=4)
    assert found[0] and not found[1]
    monkeypatch.setattr(skew, "LEAST_BUCKETS", 1 << 14)
    monkeypatch.setattr(skew, "BUCKETS", 1 << 16)
    assert hot_cells(["k"], left, left.limit(9_500), hot_rows=4) == found
