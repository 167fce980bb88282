"""Numbering rows in a total order without one task seeing them all."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import Workspace

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the lower 33 bits


def placed_rows(df: DataFrame, order: list[Column | str], name: str, workspace: Workspace, stored: bool = False) -> DataFrame:
    """Rows in order, each with its range partition (``_part``) and its row number in there (``_row``), written.

    Range partitioning reads its input twice, once to sample it, so rows that are not ``stored``
    yet are written first. They are then range-partitioned and sorted, tagged, and written again:
    from then on the places are data and no later run of the sampling can move them.
    """
    rows = df if stored else workspace.write(df, f"{name}-unordered")
    tagged = (
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return workspace.write(tagged, name).select(
        F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"), *df.columns)


def ordered_id(df: DataFrame, order: list[Column | str], column: str, workspace: Workspace,
               start: int = 0, stored: bool = False) -> DataFrame:
    """Add consecutive ids in the given order; give a total order for stable ids.

    An id is the row's place plus the number of rows in earlier partitions. Say ``stored`` for rows
    read from a table as they are.
    """
    placed = placed_rows(df, order, column, workspace, stored)
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition, so both the window and the broadcast are bounded by that setting.
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_row") + F.lit(start)).alias(column), *df.columns)


def previous_value(df: DataFrame, group: str, order: list[str], value: str, column: str,
                   workspace: Workspace, stored: bool = False) -> DataFrame:
    """Add the value of the row before, within the group, for groups of any size.

    Rows are cut into even range partitions, through the middle of a large group where need be. A
    partition's first row takes its predecessor from a table of one row per partition.
    """
    placed = placed_rows(df, [group, *order], column, workspace, stored)
    both = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    ends = placed.groupBy("_part").agg(F.max_by(both, "_row").alias("_end"))
    carried = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_carried"))
    inside = F.lag(both).over(Window.partitionBy("_part").orderBy("_row"))
    seen = placed.withColumn("_inside", inside).join(F.broadcast(carried), "_part")
    before = F.coalesce("_inside", "_carried")
    return seen.select(*df.columns, F.when(before.getField("g") == F.col(group), before.getField("v")).alias(column))
