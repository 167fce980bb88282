"""Order-independent fingerprints that tell whether two copies of a table hold the same rows, and where not.

A row's hash covers all its columns. Rows are dealt over key ranges by a hash of their key, and a range's
fingerprint is its number of rows and the sum of their hashes: adding does not depend on order or
partitions, folds in each task, and leaves at most ``ranges`` rows. A lost, added or changed row shows in
its range, so only rows of ranges that differ are compared key by key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import quoted

RANGES = 4096
_WIDE = "decimal(38,0)"


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """Hash of the named columns; a null counts as a value of its own, so values cannot change places with nulls."""
    cells = [quoted(c) for c in columns]
    return F.xxhash64(*cells, F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cells])).cast(_WIDE)


def _signed(source: DataFrame, copy: DataFrame, keys: list[str], ranges: int, *keep: str) -> DataFrame:
    """Rows of both sides: their key range, and hash and count on the side they come from."""
    columns = sorted(source.columns)
    if columns != sorted(copy.columns):
        raise ValueError(f"columns differ: {sorted(set(source.columns) ^ set(copy.columns))}")
    one, zero, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast(_WIDE)

    def side(df: DataFrame, first: bool) -> DataFrame:
        key_range = F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(ranges)).cast("int")
        own = row_hash(df, columns)
        return df.select(key_range.alias("key_range"), *[quoted(k) for k in keep], (one if first else zero).alias("source_rows"),
                         (zero if first else one).alias("copy_rows"), (own if first else none).alias("source_sum"),
                         (none if first else own).alias("copy_sum"))

    return side(source, True).unionByName(side(copy, False))


def _folded(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("source_rows", "copy_rows")],
                                 *[F.sum(c).cast(_WIDE).alias(c) for c in ("source_sum", "copy_sum")])


def _differ() -> Column:
    return (F.col("source_rows") != F.col("copy_rows")) | (F.col("source_sum") != F.col("copy_sum"))


def fingerprints(source: DataFrame, copy: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """Rows and hash sums of both sides for each key range that either holds, and whether they ``differ``."""
    return _folded(_signed(source, copy, keys, ranges), "key_range").withColumn("differ", _differ())


def agreement(source: DataFrame, copy: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """One row: rows of either side and the number of key ranges that differ. Both sides are read once."""
    return fingerprints(source, copy, keys, ranges).agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("copy_rows"), F.lit(0)).alias("copy_rows"),
        F.count_if("differ").alias("differing_ranges"))


def differences(source: DataFrame, copy: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """Keys whose rows differ: LOST (only in the source), ADDED (only in the copy) or CHANGED, with the rows of either side.

    Ranges that agree are left out by a broadcast of at most ``ranges`` numbers; in the others rows are summed per key.
    Repeated keys are compared as a whole. Keys may be null.
    """
    unequal = fingerprints(source, copy, keys, ranges).where("differ").select("key_range")
    rows = _signed(source, copy, keys, ranges, *keys).join(F.broadcast(unequal), "key_range")
    kind = F.when(F.col("copy_rows") == 0, "LOST").when(F.col("source_rows") == 0, "ADDED").otherwise("CHANGED")
    return _folded(rows, "key_range", *keys).where(_differ()).select(*keys, kind.alias("difference"), "source_rows", "copy_rows")
