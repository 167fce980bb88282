"""Checks of the vendor file registry."""

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import as_moment, as_number
from ledgerloom.operators.ids import ordered_id
from ledgerloom.sources.workspace import Workspace

_OPS, _RECON = "Custodian Operations", "Reconciliation Team"
_OUT = ["file_date", "file_type", "expected_status", "actual_status", "record_count", "issue_type", "severity",
        "owner", "review_action"]
# What the rules read of a prepared registry.
_READ = ["source_file_id", "file_name", "receipt_status", "validation_status", "expected_date", "file_type", "_expected", "_received", "_records"]


def file_type(name: Column) -> Column:
    """Part of the file name before ``_yyyymmdd``, else before the first dot; no name is UNKNOWN."""
    dated = F.regexp_extract(name, r"^(.+?)_(\d{8})", 1)
    return F.coalesce(F.when(dated != "", dated).otherwise(F.split(name, r"\.").getItem(0)), F.lit("UNKNOWN"))


def with_file_type(registry: DataFrame) -> DataFrame:
    return registry.withColumn("file_type", file_type(F.col("file_name")))


def prepared(registry: DataFrame) -> DataFrame:
    """Registry with file type and with dates and counts read, unreadable ones missing."""
    return with_file_type(registry).withColumns({
        "_expected": as_moment(registry, "expected_date"), "_received": as_moment(registry, "received_timestamp"),
        "_records": as_number(registry, "record_count").cast("double")})


# A rule on single files: rows it hits, and its issue as a struct over such a row.
_Rule = tuple[Column, Column]


def _column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _issue(rule: int, expected, actual, issue: str, severity: str, owner: str, action, *,
           file_date: Column | None = None, place: Column | None = None, text: Column | str = "") -> Column:
    """Issue fields, led by the keys that put issues in order."""
    values = {
        "_rule": F.lit(rule), "_text": _column(text),
        "_place": (F.col("source_file_id") if place is None else place).cast("bigint"),
        "file_date": (F.col("expected_date") if file_date is None else file_date).cast("string"),
        "file_type": F.col("file_type"), "expected_status": _column(expected), "actual_status": _column(actual),
        "record_count": F.col("_records"), "issue_type": F.lit(issue), "severity": F.lit(severity),
        "owner": F.lit(owner), "review_action": _column(action),
    }
    return F.struct(*[c.alias(k) for k, c in values.items()])


def _hits(files: DataFrame, *rules: _Rule) -> DataFrame:
    """Issues of all given rules from one scan of the registry."""
    any_hit = reduce(operator.or_, [hit for hit, _ in rules])
    found = [F.when(hit, issue) for hit, issue in rules]
    if len(rules) == 1:
        return files.where(any_hit).select(rules[0][1].alias("_issue")).select("_issue.*")
    return files.where(any_hit).select(F.inline(F.array_compact(F.array(*found))))


def _code(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def _missing() -> _Rule:
    return _code("receipt_status") == "MISSING", _issue(
        1, "RECEIVED", "MISSING", "MISSING_FILE", "HIGH", _OPS,
        "Chase custodian for re-delivery; hold reconciliation for affected date")


def _late(lateness_hours: int) -> _Rule:
    due = F.col("_expected") + F.make_dt_interval(hours=F.lit(fixed.RECEIPT_HOUR + lateness_hours))
    got = F.col("_received")
    hours = F.timestamp_diff("MICROSECOND", due, got) / F.lit(3.6e9)
    action = F.concat(F.lit("File received ~"), F.format_string("%.1f", hours),
                      F.lit("h after deadline; review SLA; investigate delay"))
    return got > due, _issue(2, "ON_TIME", "LATE", "LATE_FILE", "MEDIUM", _OPS, action,
                             file_date=F.col("_expected").cast("date"))


def _bounds(low: int, high: int) -> list[_Rule]:
    n = F.col("_records")
    shown = F.concat(n.cast("bigint").cast("string"), F.lit(" records"))
    return [
        (n < low, _issue(5, f">= {low} records", shown, "LOW_RECORD_COUNT", "HIGH", _OPS,
                         "Confirm file is complete; request re-delivery if truncated")),
        (n > high, _issue(6, f"<= {high} records", shown, "HIGH_RECORD_COUNT", "MEDIUM", _RECON,
                          "Verify no duplicate records were included in this file")),
    ]


def _dates() -> list[_Rule]:
    waiting = ~F.col("receipt_status").eqNullSafe("MISSING")
    return [
        (F.col("_expected").isNull(), _issue(
            7, "VALID_DATE", "INVALID_EXPECTED_DATE", "INVALID_DATE", "HIGH", _RECON,
            "Correct the expected_date field in the vendor file registry")),
        (F.col("_received").isNull() & waiting, _issue(
            8, "VALID_TIMESTAMP", "INVALID_RECEIVED_TIMESTAMP", "INVALID_DATE", "MEDIUM", _RECON,
            "Correct the received_timestamp field in the vendor file registry")),
    ]


def _failed() -> _Rule:
    return _code("validation_status") == "FAILED", _issue(
        9, "VALIDATED", "FAILED", "FAILED_VALIDATION_STATUS", "HIGH", _RECON,
        "Do not use this file in reconciliation; request corrected file from custodian")


def missing_files(files: DataFrame) -> DataFrame:
    return _hits(files, _missing())


def late_files(files: DataFrame, lateness_hours: int = fixed.LATENESS_HOURS) -> DataFrame:
    """Files received after the receipt hour plus the tolerance."""
    return _hits(files, _late(lateness_hours))


def count_bounds(files: DataFrame, low: int = fixed.MIN_RECORD_COUNT, high: int = fixed.MAX_RECORD_COUNT) -> DataFrame:
    """Files with suspiciously few or many records."""
    return _hits(files, *_bounds(low, high))


def invalid_dates(files: DataFrame) -> DataFrame:
    """Unreadable or missing expected dates, and receipt times of files not marked missing."""
    return _hits(files, *_dates())


def failed_status(files: DataFrame) -> DataFrame:
    return _hits(files, _failed())


def duplicate_names(files: DataFrame) -> DataFrame:
    """One issue per file name seen more than once, with the first file's fields."""
    first = F.min_by(F.struct("expected_date", "file_type", "_records"), "source_file_id")
    names = (files.where("file_name is not null").groupBy("file_name")
             .agg(F.count("*").alias("_n"), first.alias("_first")).where("_n > 1")
             .select("file_name", "_first.*"))
    action = F.concat(F.lit("Deduplicate '"), F.col("file_name"),
                      F.lit("'; investigate why multiple copies were received"))
    return names.select(_issue(
        3, "UNIQUE", "DUPLICATE", "DUPLICATE_FILE_NAME", "HIGH", _RECON, action, place=F.lit(0),
        text=F.col("file_name")).alias("_issue")).select("_issue.*")


def duplicate_type_dates(files: DataFrame) -> DataFrame:
    """Dates with more than one file of a type, under different names.

    Names are counted per (date, type, name) first, so a busy date is spread over its names.
    """
    per_name = files.where("expected_date is not null").groupBy("expected_date", "file_type", "file_name").agg(
        F.sum(F.col("_records")).alias("_records"))
    days = per_name.groupBy("expected_date", "file_type").agg(
        F.count("file_name").alias("_names"), F.sum("_records").alias("_records")).where("_names > 1")
    key = F.concat(F.col("expected_date").cast("string"), F.lit(" "), F.col("file_type"))
    return days.select(_issue(
        4, "ONE_FILE_PER_TYPE_PER_DAY", "MULTIPLE_FILES", "DUPLICATE_DATE_FILE_TYPE", "MEDIUM", _RECON,
        "Confirm which file is authoritative; remove the duplicate before reconciliation", place=F.lit(0),
        text=key).alias("_issue")).select("_issue.*")


def issues(result: DataFrame) -> DataFrame:
    """A rule's result without its sort keys."""
    return result.select(*_OUT)


def vendor_suite(registry: DataFrame, workspace: Workspace, lateness_hours: int = fixed.LATENESS_HOURS,
                 low: int = fixed.MIN_RECORD_COUNT, high: int = fixed.MAX_RECORD_COUNT) -> DataFrame:
    """All issues in rule order with consecutive ids; the schema stays when there are none.

    Rules on single files share one scan; the two rules on groups of files aggregate first. File types, dates and counts
    are read once and written, so no rule reads them again.
    """
    files = workspace.write(prepared(registry).select(*_READ), "vendor-files")
    single = _hits(files, _missing(), _late(lateness_hours), *_bounds(low, high), *_dates(), _failed())
    found = single.unionByName(duplicate_names(files)).unionByName(duplicate_type_dates(files))
    numbered = ordered_id(found, ["_rule", "_text", "_place"], "validation_id", workspace, start=1)
    return numbered.select("validation_id", *_OUT)


def issue_counts(found: DataFrame, by: str) -> DataFrame:
    return found.groupBy(by).agg(F.count("*").alias("issue_count"))
