"""CSV table files: typed by default, inferred on request."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from shelfweek.schemas import TABLES

# Quotes inside a field are doubled, as common CSV writers do.
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}
# What an empty field is read as. Being no text that occurs, it keeps NULL (an
# empty field) apart from empty text (a quoted empty field).
NULL_MARK = "\x01"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    *,
    header: bool = True,
    multi_line: bool = True,
    empty_is_null: bool = False,
) -> DataFrame:
    """CSV files or folders; ``.gz`` files are unpacked by their extension.

    With a schema there is no inference pass, values keep their text form where
    the type is STRING, a header that does not match the schema is an error,
    and so is a value that does not parse. Without one, Spark infers the types
    from a full read. An empty field is NULL and a quoted empty one empty text,
    unless ``empty_is_null`` says that both are NULL.

    Fields may hold line breaks. That takes one task per file, as gzip does
    anyway; large uncompressed files without line breaks inside fields are
    split with ``multi_line=False``. Large tables should arrive as many files.
    """
    null = "" if empty_is_null else NULL_MARK
    reader = spark.read.options(
        header=header, multiLine=multi_line, nullValue=null, emptyValue="", **CSV_OPTIONS
    )
    if schema is None:
        return reader.csv(path, inferSchema=True)
    # Flags arrive as 0/1 from some databases and as true/false from others;
    # the CSV parser knows only the latter, a cast from text knows both.
    as_read = StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, BooleanType) else f.dataType)
            for f in schema
        ]
    )
    raw = reader.schema(as_read).csv(path, enforceSchema=not header, mode="FAILFAST")
    return raw.select(
        [
            F.col(f.name).cast("boolean").alias(f.name)
            if isinstance(f.dataType, BooleanType)
            else F.col(f.name)
            for f in schema
        ]
    )


def load_tables(
    spark: SparkSession,
    paths: dict[str, str | list[str]],
    *,
    header: bool = True,
    infer: bool = False,
    multi_line: bool = True,
    empty_is_null: bool = False,
) -> dict[str, DataFrame]:
    """The source tables by name, each with its published schema."""
    options = {"header": header, "multi_line": multi_line, "empty_is_null": empty_is_null}
    return {
        name: read_csv(spark, path, None if infer else TABLES[name], **options)
        for name, path in paths.items()
    }
