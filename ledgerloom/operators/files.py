"""Custodian files: manifest, link to records, control totals, and dated overlays on records."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import SHARES
from ledgerloom.functions.sizing import small_side


def _expected(dates: DataFrame, date_column: str, prefix: str, position: int, receipt_hour: int) -> DataFrame:
    day = F.col(date_column)
    return dates.select(date_column).distinct().where(day.isNotNull()).select(
        F.lit(position).alias("_kind"),
        F.concat(F.lit(prefix), F.date_format(day, "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
        F.lit(fixed.SOURCE_SYSTEM).alias("source_system"),
        day.alias("expected_date"),
        F.lit("RECEIVED").alias("receipt_status"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(receipt_hour))).alias("received_timestamp"),
        F.lit("VALIDATED").alias("validation_status"),
    )


def file_manifest(balances: DataFrame, positions: DataFrame, balance_date: str = "ledger_date",
                  position_date: str = "position_date", receipt_hour: int = fixed.RECEIPT_HOUR) -> DataFrame:
    """One expected balance file per balance date and one position file per position date."""
    files = _expected(balances, balance_date, fixed.BALANCE_FILE_PREFIX, 0, receipt_hour).unionByName(
        _expected(positions, position_date, fixed.POSITION_FILE_PREFIX, 1, receipt_hour))
    # Two rows per calendar day at most, so one sorted group is enough.
    numbered = Window.orderBy("_kind", "expected_date")
    return files.select((F.row_number().over(numbered) - 1).cast("bigint").alias("source_file_id"), *files.columns[1:])


def _files_of(manifest: DataFrame, prefix: str) -> DataFrame:
    return manifest.where(F.col("file_name").startswith(prefix))


def file_link(records: DataFrame, manifest: DataFrame, date_column: str, prefix: str) -> DataFrame:
    """Records with the id of the file of their date; records of dates without a file drop out."""
    files = _files_of(manifest, prefix).select("source_file_id", F.col("expected_date").alias(date_column))
    return records.join(small_side(files), date_column)


def file_control_totals(records: DataFrame, manifest: DataFrame, value_column: str, prefix: str) -> DataFrame:
    """Manifest with record count and total of the matching files filled in, others as they were."""
    totals = records.groupBy("source_file_id").agg(
        F.count("*").alias("_count"), F.sum(value_column).cast(SHARES).alias("_total"))
    if "record_count" not in manifest.columns:
        manifest = manifest.withColumns(
            {"record_count": F.lit(None).cast("bigint"), "control_total": F.lit(None).cast(SHARES)})
    wanted = F.col("file_name").startswith(prefix)
    keep = [c for c in manifest.columns if c not in ("record_count", "control_total")]
    return manifest.join(totals, "source_file_id", "left").select(
        *keep,
        F.when(wanted, F.coalesce("_count", "record_count")).otherwise(F.col("record_count")).alias("record_count"),
        F.when(wanted & F.col("_count").isNotNull(), F.col("_total")).otherwise(F.col("control_total"))
        .alias("control_total"),
    )


def control_total_tieout(records: DataFrame, manifest: DataFrame, value_column: str, prefix: str) -> DataFrame:
    """Files whose records no longer agree with the count or total the manifest recorded."""
    actual = records.groupBy("source_file_id").agg(
        F.count("*").alias("actual_count"), F.sum(value_column).cast(SHARES).alias("actual_total"))
    zero = F.lit(0).cast(SHARES)
    return (
        _files_of(manifest, prefix).join(actual, "source_file_id", "left")
        .select(
            "source_file_id", "file_name", "record_count",
            F.coalesce("actual_count", F.lit(0).cast("bigint")).alias("actual_count"),
            F.coalesce("control_total", zero).cast(SHARES).alias("control_total"),
            F.coalesce("actual_total", zero).alias("actual_total"),
        )
        .withColumn("total_variance", (F.col("control_total") - F.col("actual_total")).cast(SHARES))
        .where("not (record_count <=> actual_count) or total_variance <> 0")
    )


def adjustment_segments(adjustments: DataFrame, keys: list[str]) -> DataFrame:
    """Non-overlapping day ranges per key with the summed delta and the highest id in force.

    Input: injection_id, keys, effective_date, delta, carry_forward. An adjustment holds from its
    date on when carried forward, else on that day only. One record then meets one segment at
    most, so adjustments never multiply rows.
    """
    day, carried = F.col("effective_date"), F.col("carry_forward")
    none = F.lit(None).cast("int")
    zero = F.lit(0).cast(SHARES)
    starts = adjustments.select(
        *keys, day.alias("starts"),
        F.when(carried, F.col("delta")).otherwise(zero).alias("lasting"),
        F.when(carried, F.col("injection_id")).otherwise(none).alias("lasting_id"),
        F.when(~carried, F.col("delta")).otherwise(zero).alias("single"),
        F.when(~carried, F.col("injection_id")).otherwise(none).alias("single_id"),
    )
    ends = adjustments.where(~carried).select(
        *keys, F.date_add(day, 1).alias("starts"), zero.alias("lasting"), none.alias("lasting_id"),
        zero.alias("single"), none.alias("single_id"))
    points = starts.unionByName(ends).groupBy(*keys, "starts").agg(
        F.sum("lasting").alias("lasting"), F.max("lasting_id").alias("lasting_id"),
        F.sum("single").alias("single"), F.max("single_id").alias("single_id"))
    in_order = Window.partitionBy(*keys).orderBy("starts")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    return points.select(
        *keys, "starts", F.lead("starts").over(in_order).alias("ends_before"),
        (F.sum("lasting").over(so_far) + F.col("single")).cast(SHARES).alias("delta"),
        F.greatest(F.max("lasting_id").over(so_far), F.col("single_id")).alias("segment_id"),
    )


def _month(day: Column) -> Column:
    return F.trunc(day, "MM")


def monthly_segments(segments: DataFrame, last_day: Column) -> DataFrame:
    """Segments cut at month borders, each piece with its ``month``; open ones run to the month of ``last_day``.

    A key has one open segment at most, and segments do not overlap, so there are no more pieces than
    segments plus months a key, and no more than a month has days in one key and month.
    """
    start = F.col("starts")
    last = F.greatest(start, F.coalesce(F.date_sub("ends_before", 1), last_day))
    months = F.sequence(_month(start), _month(last), F.expr("interval 1 month"))
    return segments.select("*", F.explode(months).alias("month"))


def apply_adjustments(records: DataFrame, adjustments: DataFrame, keys: list[str], date_column: str,
                      value_column: str) -> DataFrame:
    """Records with the deltas in force added, tagged with the adjustment id and a flag.

    Small segment tables are broadcast after a count, so the records are not shuffled; larger ones
    meet them in a shuffle join. Either way both sides meet on key and month, with no more than a month's days to
    look through for a record, and the months of a hot account lie in different partitions.
    """
    day = F.col(date_column)
    last_day = records.agg(F.max(day).cast("date").alias("last")).scalar()
    segments = adjustment_segments(adjustments, keys).where("segment_id is not null")
    pieces = small_side(monthly_segments(segments, last_day).withColumnsRenamed({k: f"_{k}" for k in keys}))
    hit: Column = (F.col("month") == _month(day)) & (day >= F.col("starts")) & (
        F.col("ends_before").isNull() | (day < F.col("ends_before")))
    for k in keys:
        hit = hit & (F.col(k) == F.col(f"_{k}"))
    kind = records.schema[value_column].dataType
    value = (F.col(value_column) + F.coalesce("delta", F.lit(0).cast(SHARES))).cast(kind)
    injected = F.col("segment_id").isNotNull()
    old_id = F.col("injection_id") if "injection_id" in records.columns else F.lit(None).cast("int")
    old_flag = F.col("simulation_flag") if "simulation_flag" in records.columns else F.lit("CLEAN")
    rest = [c for c in records.columns if c not in (value_column, "injection_id", "simulation_flag")]
    return records.join(pieces, hit, "left").select(
        *rest, value.alias(value_column),
        F.when(injected, F.lit("INJECTED")).otherwise(old_flag).alias("simulation_flag"),
        F.coalesce("segment_id", old_id).alias("injection_id"),
    )


def apply_misposting(positions: DataFrame, injection_id: int, day: str, ticker: str, shares: str,
                     right_account: int, wrong_account: int) -> DataFrame:
    """Post a holding to the wrong account on its day and take it from the right one from then on.

    The stray row borrows the remaining fields of the first record of that day.
    """
    spark = positions.sparkSession
    stamped = {
        "account_id": F.lit(wrong_account).cast(positions.schema["account_id"].dataType),
        "ticker": F.lit(ticker),
        "custodian_share_quantity": F.lit(shares).cast(SHARES),
        "simulation_flag": F.lit("INJECTED"),
        "injection_id": F.lit(injection_id).cast("int"),
    }
    first = positions.where(F.col("position_date") == F.lit(day).cast("date")).orderBy("account_id", "ticker").limit(1)
    taken = spark.range(1).select(
        F.lit(injection_id).cast("int").alias("injection_id"), F.lit(right_account).alias("account_id"),
        F.lit(ticker).alias("ticker"), F.lit(day).cast("date").alias("effective_date"),
        (-F.lit(shares).cast(SHARES)).alias("delta"), F.lit(True).alias("carry_forward"))
    reduced = apply_adjustments(positions, taken, ["account_id", "ticker"], "position_date",
                                "custodian_share_quantity")
    return reduced.unionByName(first.withColumns(stamped).select(*reduced.columns))


def mark_missing_file(manifest: DataFrame, day: str, prefix: str) -> DataFrame:
    """Manifest with the file of one day marked as not received."""
    hit = (F.col("expected_date") == F.lit(day).cast("date")) & F.col("file_name").startswith(prefix)
    return manifest.withColumns({
        "receipt_status": F.when(hit, F.lit("MISSING")).otherwise(F.col("receipt_status")),
        "validation_status": F.when(hit, F.lit("FAILED")).otherwise(F.col("validation_status")),
        "received_timestamp": F.when(~hit, F.col("received_timestamp")),
    })
