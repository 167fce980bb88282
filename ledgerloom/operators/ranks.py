"""Values at given ranks of many groups at once, exact and for groups of any size."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ids import placed_rows
from ledgerloom.sources.workspace import Workspace


def group_quantiles(df: DataFrame, group: str, value: str, shares: Sequence[float], workspace: Workspace) -> DataFrame:
    """``group``, ``n`` and ``quantiles``: the value at each share of every group, linearly interpolated between ranks.

    Rows are counted per group and value, and these counts are range-partitioned in order, so a large group is cut over many
    partitions. One row per group and partition tells how many rows lie before it; only the partitions that hold a wanted rank
    are then counted through, each on its own. Nothing is sketched, and no task sees more of a group than one range partition.
    Rows with a null group or value are left out.
    """
    counted = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    placed = placed_rows(counted, [group, value], "ranks", workspace)
    # one row per group and partition: a window of a group is bounded by the number of partitions
    sums = placed.groupBy("_part", group).agg(F.sum("_n").alias("_sum"))
    of_group = Window.partitionBy(group)
    spread = sums.select(
        "_part", group, "_sum", F.sum("_sum").over(of_group).alias("n"),
        F.coalesce(F.sum("_sum").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    positions = [F.lit(float(s)) * (F.col("n") - 1) for s in shares]
    wanted = F.array(*[F.struct(F.lit(i).alias("slot"), rank(p).cast("bigint").alias("rank"))
                       for i, (p, rank) in enumerate((p, rank) for p in positions for rank in (F.floor, F.ceil))])
    within = lambda low, high: lambda w: (w.getField("rank") >= low) & (w.getField("rank") < high)
    targets = spread.withColumn("_wanted", F.filter(wanted, within(F.col("_before"), F.col("_before") + F.col("_sum")))) \
        .where(F.size("_wanted") > 0).drop("_sum")
    inside = Window.partitionBy("_part", group).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    passed = placed.join(targets, ["_part", group]).withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    met = passed.select(group, "n", value, F.explode(F.filter("_wanted", within(F.col("_upto") - F.col("_n"), F.col("_upto")))).alias("_w"))
    slots = [F.max(F.when(F.col("_w.slot") == i, F.col(value))).alias(f"_v{i}") for i in range(2 * len(shares))]

    def between(i: int, position: Column) -> Column:
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        return low + (high - low) * (position - F.floor(position))

    return met.groupBy(group, "n").agg(*slots).select(
        group, "n", F.array(*[between(i, p) for i, p in enumerate(positions)]).alias("quantiles"))
