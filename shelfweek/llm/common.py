"""Checkpoints, connected components and small helpers shared by the operators."""

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.skew import checked_broadcast
from shelfweek.sinks.scratch import is_local

# What separates words, everywhere in this package: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
# Texts reach a Python task in batches of about this size.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
# Rows of a checkpoint file, where the number of rows is known.
ROWS_PER_FILE = 200_000


def checkpoint(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df`` computed once and kept in ``spark.checkpoint.dir``, its lineage cut.

    Where it is known to have ``most`` rows at most, its last stage and what reads
    it run as few tasks as that takes; that suits small rows fresh from a shuffle,
    not the work of a scan. Where that setting is missing, a local master gets a folder of its own and
    any other master an error, as executors could not read the driver's disk.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    return (df if most is None else df.coalesce(most // ROWS_PER_FILE + 1)).checkpoint()


def small_batches(spark) -> None:
    """Lets texts reach Python tasks in small batches, unless the session says how large.

    Spark's own batches are of 10,000 rows, whatever their length; executor and
    Python worker each hold several of them.
    """
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def quoted(name: str) -> str:
    """A column name as it is, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def named(columns) -> list[Column]:
    return [F.col(quoted(c)) for c in columns]


def plainly(columns) -> tuple[list[str], list[Column]]:
    """Names without dots for the columns, which Python stages need, and the columns so named."""
    names = [f"c{n}" for n in range(len(columns))]
    return names, [c.alias(n) for c, n in zip(named(columns), names)]


def renamed(names, columns) -> list[Column]:
    """The columns back under their own names."""
    return [F.col(n).alias(c) for n, c in zip(names, columns)]


def fresh(name: str, columns) -> str:
    """``name``, lengthened until it is none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has been measured and is small enough."""
    marked = checked_broadcast(df)
    return df if marked is None else marked


def condition(given: Column | str) -> Column:
    """A condition given as a column or as SQL text; null counts as false."""
    return F.coalesce(F.expr(given) if isinstance(given, str) else given, F.lit(False))


def uniform(*columns) -> Column:
    """A number in (0, 1) that depends on the columns only, so reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def sampled(df: DataFrame, most: int, *key: str) -> DataFrame:
    """``most`` rows at most, chosen by the hash of ``key`` alone, so reruns agree.

    The rows are counted first, so that about twice as many reach the last step,
    however many tasks there are.
    """
    n, wanted = df.count(), max(2 * most, 100)
    some = df.where(uniform(*key) < wanted / n) if n > 2 * wanted else df
    return some.orderBy(F.xxhash64(*key), *key).limit(most)


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (id, component) for every id on an edge (a, b): its smallest reachable id.

    Alternating large and small stars: each round hangs the larger neighbours
    of a node on the smallest id it knows, until every component is one star.
    Minima combine map-side, so a node with very many neighbours costs no task
    more than its share. Ids are longs; edges with a null end are ignored.
    ``most`` is a bound on the number of edges, if one is known.
    """
    pair = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    # No round has more edges than the one before.
    stars = checkpoint(pair.distinct(), most)
    while _unfinished(stars):
        stars = checkpoint(_small_star(_large_star(stars)), most)
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node hangs on two others, or on one while another hangs on it."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not nodes.where("hangs + holds > 1 AND hangs > 0").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    lowest = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("low"))
    return edges.join(lowest, "v").select("u", F.least("v", "low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(lowest, "u").where("v <> low").select(F.col("v").alias("u"), "low")
    return moved.union(lowest.select("u", "low")).toDF("u", "v").distinct()
