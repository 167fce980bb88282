"""Readers and writers."""

from collections.abc import Collection, Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.sizing import small_side
from ledgerloom.sources.schemas import RAW_TRANSACTIONS
from ledgerloom.sources.workspace import Workspace


# Splits whose starts may be broadcast: 128 TB in splits of 128 MB, and the bytes of as many rows of four numbers.
_MAX_SPLITS, _MAX_SPLIT_BYTES = 1_000_000, 64 << 20


def read_csv_numbered(
    spark: SparkSession,
    path: str,
    workspace: Workspace,
    schema: StructType = RAW_TRANSACTIONS,
    id_column: str = "source_row_id",
    start: int = 1,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header as a table of text columns, plus a row number in file order.

    Rows are not sorted. They are written once as Parquet, each with the task that read it, its file split and the order
    it was read in, so a later read that splits the files differently cannot change them. The
    running row count over splits then gives the number at which a split begins. A task reads its splits one
    after the other, so a row finds its split by numbers alone: that of its task, which holds
    a few splits, and the range of its place there. Names of files stay out of the join.
    """
    tagged = (
        spark.read.schema(schema).option("header", True).option("multiLine", multi_line).csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.spark_partition_id().alias("_task"),
            F.monotonically_increasing_id().alias("_seen"),
        )
    )
    rows = workspace.write(tagged, "csv-rows")
    starts = workspace.write(split_starts(rows), "csv-splits")
    own = (F.col("_task") == F.col("_reader")) & F.col("_seen").between(F.col("_first"), F.col("_last"))
    return rows.join(small_side(starts, _MAX_SPLITS, _MAX_SPLIT_BYTES), own).select(
        (F.col("_seen") + F.col("_shift") + F.lit(start)).alias(id_column),
        *[F.col(f"`{c}`") for c in schema.fieldNames()],
    )


def split_starts(rows: DataFrame) -> DataFrame:
    """For each file split the task that read it, its first and last place there, and the shift from places to numbers.

    Splits are in the order of their files' paths and of their place in a file. Their rows are summed in two steps, files first, so no window
    holds more than the splits of a file or one row per file.
    """
    splits = rows.groupBy("_file", "_block", "_task").agg(F.min("_seen").alias("_first"), F.max("_seen").alias("_last"), F.count("*").alias("_n"))
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_file = splits.withColumn("_in_file", earlier(Window.partitionBy("_file").orderBy("_block")))
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_n")).select("_file", earlier(Window.orderBy("_file")).alias("_before"))
    return in_file.join(files, "_file").select(
        F.col("_task").alias("_reader"), "_first", "_last", (F.col("_before") + F.col("_in_file") - F.col("_first")).alias("_shift"))


def read_table(
    spark: SparkSession,
    path: str,
    required: Iterable[str],
    optional: bool = False,
    **options,
) -> DataFrame | None:
    """Table by path if it exists with all required columns, else ``None`` so its checks are skipped.

    The format follows the suffix (``.csv`` or Parquet). ``optional`` silences the notice.
    """
    try:
        if path.rstrip("/").endswith(".csv"):
            df = spark.read.options(header=True, **options).csv(path)
        else:
            df = spark.read.options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        if not optional:
            print(f"skipped: {path} not found")
        return None
    missing = sorted(set(required) - set(df.columns))
    if missing:
        if not optional:
            print(f"skipped: {path} lacks {missing}")
        return None
    return df


def read_required(spark: SparkSession, path: str, required: Iterable[str], **options) -> DataFrame | None:
    return read_table(spark, path, required, **options)


def read_optional(spark: SparkSession, path: str, required: Iterable[str], **options) -> DataFrame | None:
    return read_table(spark, path, required, optional=True, **options)


# Blanks stay, and quotes are doubled as other readers expect.
_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV without a row index; one file per task. Missing values are left empty."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``write_csv`` wrote, line breaks inside values included; empty text comes back as missing."""
    return spark.read.schema(schema).options(**_CSV, multiLine=True).csv(path)


MONTH = "year_month"


def write_by_month(df: DataFrame, path: str, date_column: str, only_months_written: bool = False, append: bool = False) -> None:
    """Parquet split by year-month, so date filters prune folders.

    Rows are brought together by month; adaptive execution gives a busy month as many writers as its
    size asks for (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each) and joins small months.
    The table is replaced; with ``only_months_written`` other months stay as they are, and with ``append`` all rows stay.
    """
    monthly = df.withColumn(MONTH, F.date_format(date_column, "yyyy-MM")).hint("rebalance", MONTH)
    kind = "dynamic" if only_months_written else "static"
    monthly.write.mode("append" if append else "overwrite").option("partitionOverwriteMode", kind).partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str, schema: str, date_column: str, first: date | None = None,
                last: date | None = None) -> DataFrame:
    """Rows of a table by month from the ``first`` to the ``last`` day; folders of other months are not read."""
    # The month is given a type: left to inference, its text would be read as a date.
    rows = spark.read.schema(f"{schema}, {MONTH} string").parquet(path)
    if first is not None:
        rows = rows.where((F.col(MONTH) >= f"{first:%Y-%m}") & (F.col(date_column) >= F.lit(first)))
    if last is not None:
        rows = rows.where((F.col(MONTH) <= f"{last:%Y-%m}") & (F.col(date_column) <= F.lit(last)))
    return rows.drop(MONTH)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def months_of(spark: SparkSession, path: str) -> list[str]:
    """Months that a table by month has a folder for, in order; none where there is no table."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{MONTH}="))


def drop_months_after(spark: SparkSession, path: str, last: str, keep: Collection[str] = ()) -> None:
    """Take away the months after ``last``, but for those to ``keep``."""
    for month in months_of(spark, path):
        if month > last and month not in keep:
            target, files = _file_system(spark, f"{path}/{MONTH}={month}")
            files.delete(target, True)


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Rebuild a derived table in place; running it twice leaves the same rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def seed_if_absent(new: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the new rows whose key it lacks."""
    absent = new.join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(absent.select(*target.columns))
