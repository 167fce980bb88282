"""Broadcast only after measuring."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_ROWS = 200_000
SMALL_BYTES = 32 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values, about: text by its length, nested values by their text, others 16."""
    sizes = [F.lit(16 * len(df.columns))]
    for field in df.schema:
        c = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    return sum(sizes[1:], sizes[0]).cast("bigint")


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Broadcast hint when counting proves the side small in rows and bytes; else the frame as it is.

    At most ``max_rows + 1`` rows are read. Without the hint the join runs as a shuffle join, which
    adaptive execution splits where a key is hot.
    """
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
