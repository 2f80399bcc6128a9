"""Fact, dimension and landing writers."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shelfweek.schemas import FACT_PARTITIONS
from shelfweek.sinks.scratch import file_system, moved, scratch_name
from shelfweek.sources.files import CSV_OPTIONS

FACT_NAME = "sales_inv"
# A gzip file is read by one task, so extracts are cut into files of this many rows.
FILE_ROWS = 2_000_000
# Spark's CSV writer trims text and marks empty text, unless told otherwise.
CSV_WRITE = {
    **CSV_OPTIONS,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "",
    "emptyValue": '""',
}

# An extract is packed to be read once or twice: this level takes about half of the default's
# time for a tenth more bytes.
LANDING_GZIP = {"compression": "gzip", "zlib.compress.level": "THREE"}


def under(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def gathered(
    rows: DataFrame, partitions: list[str], sorted_by: list[str] | None = None
) -> DataFrame:
    """``rows`` laid out for a partitioned write: few files per folder, none of them large.

    With ``sorted_by`` every task gets a range of folders and of those columns,
    in their order. The files of a folder, and the row groups of a file, then
    hold ranges that do not overlap, so a reader that looks for some of the
    values skips the others by their statistics. The ranges are found from a
    sample, for which ``rows`` is computed once more: give a written table. Equal
    rows stay together, so this is for tables of distinct rows.
    """
    if sorted_by is None:
        return rows.hint("rebalance", *partitions)
    order = [*partitions, *sorted_by]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_fact(
    fact: DataFrame,
    out: str,
    mode: str = "overwrite",
    compression: str = "gzip",
    *,
    dynamic: bool = False,
    clustered: bool = False,
    sorted_by: list[str] | None = None,
    name: str = FACT_NAME,
) -> str:
    """Parquet below ``<out>/<name>``, in year and week folders.

    Rows are gathered by folder first, so that a folder gets few files; a week
    too large for one task is divided, small weeks share one. Set ``clustered``
    where that has been done. With ``sorted_by`` the rows of a week lie in that
    order, see ``gathered``. Overwriting replaces every folder, or with
    ``dynamic`` only those that ``fact`` has rows for; readers have neither the
    old nor the new rows until it is done (``publish_table`` is for that).
    """
    path = under(out, name)
    laid_out = fact if clustered else gathered(fact, FACT_PARTITIONS, sorted_by)
    (
        laid_out.write.mode(mode)
        .partitionBy(*FACT_PARTITIONS)
        .option("compression", compression)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .parquet(path)
    )
    return path


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", *, single_file: bool = True
) -> str:
    """CSV with a header, written by one task into one file, or by every task of ``df``.

    NULL is an empty field and empty text a quoted one; blanks stay as they are.
    A single file suits dimensions; give ``single_file=False`` for large tables.
    """
    writer = (df.repartition(1) if single_file else df).write.mode(mode)
    writer.options(header=True, **CSV_WRITE).csv(path)
    return path


def write_snapshot(
    df: DataFrame,
    out: str,
    name: str,
    run_date: date,
    mode: str = "overwrite",
    *,
    single_file: bool = True,
) -> str:
    """Dated CSV copy of a dimension below ``<out>/<name>/date=<run_date>``."""
    path = under(out, name, f"date={run_date:%Y-%m-%d}")
    return write_csv(df, path, mode, single_file=single_file)


def write_landing(
    df: DataFrame,
    landing: str,
    table: str,
    run_date: date,
    mode: str = "overwrite",
    *,
    file_rows: int = FILE_ROWS,
) -> str:
    """Gzip CSV extract of a table with a header, in files of ``file_rows`` at most."""
    path = under(landing, table, f"date={run_date:%Y-%m-%d}")
    (
        df.write.mode(mode)
        .options(header=True, maxRecordsPerFile=file_rows, **LANDING_GZIP, **CSV_WRITE)
        .csv(path)
    )
    return path


def write_landing_file(df: DataFrame, landing: str, table: str, run_date: date) -> str:
    """Gzip CSV extract in the one file ``<landing>/<table>_<run_date>.csv.gz``.

    One task writes it, so this is for dimensions; ``write_landing`` is for the rest.
    The file appears under its name only once it is whole, and takes the place
    of an earlier one in one step.
    """
    spark = df.sparkSession
    folder = under(landing, scratch_name(f"_{table}"))
    options = {"header": True, **LANDING_GZIP, **CSV_WRITE}
    df.repartition(1).write.options(**options).csv(folder)
    path = under(landing, f"{table}_{run_date:%Y-%m-%d}.csv.gz")
    files, place = file_system(spark, folder)
    (part,) = files.globStatus(place(under(folder, "part-*")))
    moved(spark, part.getPath().toString(), path, replace=True)
    files.delete(place(folder), True)
    return path


def mark_finished(spark: SparkSession, folders: str) -> None:
    """Puts a success marker into every folder of a pattern.

    A partitioned write marks its own folder only, not the dated ones below.
    """
    files, place = file_system(spark, folders)
    for folder in files.globStatus(place(folders)):
        files.create(place(folder.getPath(), "_SUCCESS"), True).close()
