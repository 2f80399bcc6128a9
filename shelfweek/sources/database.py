"""Whole-table snapshots over JDBC, read by many tasks at once."""

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    *,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one table; ``column`` and ``bounds`` split the read."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if column is not None and bounds is not None and partitions > 1:
        low, high = bounds
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    column: str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """All rows of a database table.

    With a numeric, date or timestamp ``column`` the table is read in ranges of
    it. The bounds come from the database and only place the cuts: rows outside
    them, and rows with a NULL there, are still read.
    """
    bounds = None
    if column is not None and partitions > 1:
        span = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) span"
        row = (
            spark.read.format("jdbc")
            .options(**jdbc_options(url, span, properties=properties))
            .load()
            .first()
        )
        bounds = None if row is None or row[0] is None else (row[0], row[1])
    options = jdbc_options(
        url,
        table,
        column=column,
        bounds=bounds,
        partitions=partitions,
        fetch_size=fetch_size,
        properties=properties,
    )
    return spark.read.format("jdbc").options(**options).load()
