"""Column expressions shared by the operators."""

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(19,4)"
SHARES = "decimal(28,8)"
PRICE = "decimal(19,6)"


def quoted(name: str) -> Column:
    """Column by its exact name, also where the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def match_key(c: Column) -> Column:
    """Text key for joins that ignore case and outer blanks."""
    return F.lower(F.trim(c))


def money(value) -> Column:
    return F.lit(str(value)).cast(SHARES)


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    """First of the candidate column names that the frame has."""
    return next((n for n in names if n in df.columns), None)


def literal_frame(spark: SparkSession, rows: list[tuple], columns: list[tuple[str, str]]) -> DataFrame:
    """Frame of in-code rows that the planner knows the exact size of.

    Columns are (name, Spark type); values travel as text and are cast, so dates and decimals
    can be written as strings.
    """
    table = pa.table({
        name: pa.array([None if r[i] is None else str(r[i]) for r in rows], pa.string())
        for i, (name, _) in enumerate(columns)
    })
    return spark.createDataFrame(table).select(*[F.col(n).cast(t).alias(n) for n, t in columns])


def as_number(df: DataFrame, name: str) -> Column:
    """Numeric column as it is, text as a decimal with unreadable values missing."""
    c = quoted(name)
    return c if isinstance(df.schema[name].dataType, T.NumericType) else c.cast("string").try_cast(SHARES)


def as_day(df: DataFrame, name: str) -> Column:
    """Date column as it is, a timestamp's day, or text as a date with unreadable values missing."""
    c, kind = quoted(name), df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return c
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return c.cast("string").try_cast("date")


def as_moment(df: DataFrame, name: str) -> Column:
    """Timestamp without zone, from text with unreadable values missing."""
    c, kind = quoted(name), df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp_ntz")
    return c.cast("string").try_cast("timestamp_ntz")


def null_count(c: Column) -> Column:
    return F.count_if(c.isNull())


def label_ladder(value: Column, steps: list[tuple], below: str) -> Column:
    """Label of the first step whose bound the value strictly exceeds."""
    out = F.lit(below)
    for bound, label in reversed(steps):
        out = F.when(value > F.lit(bound), label).otherwise(out)
    return out


def lookup(key: Column, mapping: dict[str, str], default: Column | str | None) -> Column:
    """In-plan lookup in a fixed map; it needs no join."""
    out = default if isinstance(default, Column) else F.lit(default)
    for k, v in reversed(list(mapping.items())):
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out
