"""Catalog tables over the written outputs."""

import json
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from shelfweek.schemas import CALENDAR, FACT_PARTITIONS, PRODUCT, STORE
from shelfweek.sinks.publish import changes, version_numbers, version_of
from shelfweek.sinks.writers import FACT_NAME, under
from shelfweek.sources.files import NULL_MARK

# Folder name of a NULL, and the table property that tells the version a table shows.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SHOWN = "published_version"
# Partitions added or dropped by one statement.
AT_ONCE = 200
DIMENSIONS = {"store": STORE, "product": PRODUCT, "calendar": CALENDAR}


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(spark: SparkSession, table: str, schema: StructType) -> bool:
    now = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    return now == {f.name.lower(): f.dataType for f in schema}


def _registered(spark, table: str, schema: StructType, using: str, partitions: str, path: str) -> str:
    """The external table, made anew if its columns have changed, with just the folders there are."""
    if spark.catalog.tableExists(table) and not _matches(spark, table, schema):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) USING {using} "
        f"PARTITIONED BY ({partitions}) LOCATION {_text(path)}"
    )
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    return table


def register_fact(
    spark: SparkSession, out: str, table: str = FACT_NAME, name: str = FACT_NAME
) -> str:
    """A partitioned table over the fact files of ``<out>/<name>``.

    Repeat after every run: folders that have come or gone are synchronised.
    """
    path = under(out, name)
    schema = spark.read.parquet(path).schema
    return _registered(spark, table, schema, "parquet", ", ".join(FACT_PARTITIONS), path)


def register_dimension(
    spark: SparkSession, out: str, name: str, table: str | None = None
) -> str:
    """A table over the dated CSV copies of a dimension, one partition per date."""
    using = (
        "csv OPTIONS (header 'true', escape '\"', multiLine 'true', emptyValue '', "
        f"nullValue {_text(NULL_MARK)})"
    )
    schema = StructType([*DIMENSIONS[name], StructField("date", DateType())])
    return _registered(spark, table or name, schema, using, "`date`", under(out, name))


def register_published(spark: SparkSession, root: str, table: str = FACT_NAME) -> str:
    """A table over the last published version of ``root``.

    The table remembers which version it shows. Only the partitions that have
    been added, moved to another folder or dropped since then are told to the
    catalog; no folder is listed.
    """
    version = version_of(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing has been published below {root}")
    schema = StructType.fromJson(json.loads(version.schema))
    before = None
    if spark.catalog.tableExists(table):
        shown = [r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r.key == SHOWN]
        if shown and int(shown[0]) in version_numbers(spark, root) and _matches(spark, table, schema):
            before = version_of(spark, root, int(shown[0]))
        else:
            spark.sql(f"DROP TABLE {table}")
    if before is None:
        spark.sql(
            f"CREATE TABLE {table} ({_columns(schema)}) USING parquet "
            f"PARTITIONED BY ({', '.join(version.partitions)}) LOCATION {_text(root)}"
        )
    base = root.rstrip("/")

    def spec(key):
        values = ("NULL" if v == NO_VALUE else _text(unquote(v)) for v in key)
        return "PARTITION (" + ", ".join(f"`{c}` = {v}" for c, v in zip(version.partitions, values)) + ")"

    def place(folder):
        return f"LOCATION {_text(f'{base}/{folder}')}"

    delta = changes(before, version)
    added = [f"{spec(key)} {place(folder)}" for key, folder in delta.added.items()]
    for at in range(0, len(added), AT_ONCE):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added[at : at + AT_ONCE])}")
    for key, folder in delta.moved.items():
        spark.sql(f"ALTER TABLE {table} {spec(key)} SET {place(folder)}")
    gone = [spec(key) for key in delta.gone]
    for at in range(0, len(gone), AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone[at : at + AT_ONCE])}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SHOWN}' = '{version.number}')")
    spark.catalog.refreshTable(table)
    return table


def register_outputs(spark: SparkSession, out: str, prefix: str = "") -> dict[str, str]:
    """Tables for the fact and the three dimensions, by output name."""
    tables = {FACT_NAME: register_fact(spark, out, prefix + FACT_NAME)}
    for name in DIMENSIONS:
        tables[name] = register_dimension(spark, out, name, prefix + name)
    return tables
