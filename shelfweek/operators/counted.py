"""Frames that hold each distinct row once, with the number of its copies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.skew import dimension_join

COPIES = "ROW_COPIES"
# Copies that one shuffled row stands for, and rows that one counted row may
# be cut into before the shuffle; larger counts get larger pieces.
PIECE = 64
MAX_PIECES = 1 << 16
# Copies up to which a row that is spread already is repeated where it is.
IN_PLACE = 1 << 12
# Rows of one group that a clustered task writes together.
FILE_ROWS = 5_000_000


def unroll(
    counted: DataFrame, cluster_by: list[str] | None = None, *, file_rows: int = FILE_ROWS
) -> DataFrame:
    """Repeats every row of ``counted`` as often as its ROW_COPIES says.

    A row with many copies is cut into pieces, the pieces are spread over the
    cluster, and only then repeated, so one heavy row does not fill one task
    and the repeated rows are not shuffled.

    With ``cluster_by``, for a partitioned write, rows of equal values meet in
    one task, or in several where their copies exceed ``file_rows``. That takes
    a second reading of ``counted``, which should be a written table.
    """
    columns = [c for c in counted.columns if c != COPIES]
    copies = F.col(COPIES)
    size = F.greatest(F.lit(PIECE), F.ceil(copies / MAX_PIECES)).cast("bigint")
    pieces = (
        counted.filter(copies > 0)
        .withColumn("__size", size)
        .withColumn("__piece", F.explode(F.expr(f"sequence(0, ({COPIES} - 1) div __size)")))
        .withColumn("__n", F.least(F.col("__size"), copies - F.col("__piece") * F.col("__size")))
        .drop(COPIES, "__size")
    )
    # The number of partitions is given: the pieces are small, and adaptive
    # merging by size would put all the work they stand for into few tasks.
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if cluster_by:
        groups = counted.groupBy(*cluster_by).agg(
            F.ceil(F.sum(copies) / file_rows).cast("bigint").alias("__files")
        )
        file = F.pmod(F.xxhash64(*columns, "__piece"), F.coalesce("__files", F.lit(1)))
        filed = dimension_join(pieces, groups, cluster_by, "left", load=counted)
        spread = filed.withColumn("__file", file).repartition(tasks, *cluster_by, "__file")
    else:
        spread = pieces.repartition(tasks, *columns, "__piece")
    return spread.select(*columns, F.explode(F.expr("sequence(1, __n)")).alias("__copy")).drop(
        "__copy"
    )


def unroll_spread(counted: DataFrame) -> DataFrame:
    """``unroll`` of rows that are spread over the cluster already, as by the cells of a join.

    Rows with few copies, of which there may be nearly as many as copies, are
    repeated where they are; only the others are cut and shuffled. A shuffle is
    worth its cost for rows that alone are much of a task's work, not for a few
    hundred copies, of which the spread rows even out the numbers. ``counted`` is
    computed twice.
    """
    columns = [c for c in counted.columns if c != COPIES]
    few = F.col(COPIES) <= IN_PLACE
    copy = F.explode(F.expr(f"sequence(1L, {COPIES})")).alias("__copy")
    in_place = counted.filter(few & (F.col(COPIES) > 0)).select(*columns, copy).drop("__copy")
    return in_place.unionByName(unroll(counted.filter(~few)))
