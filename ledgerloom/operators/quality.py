"""Rule-based data-quality checks of any table, one result row per check.

Everything that is a count over rows is taken in one aggregate per table. Only repeated ids,
repeated rows and samples of bad codes need their own small jobs, which enter as scalars.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import literal_frame, quoted

_PASS_FIX = "No action required"
_RESULT = ["check_name", "check_status", "failed_record_count", "severity", "issue_description", "suggested_fix"]


@dataclass(frozen=True)
class QualitySpec:
    """What to check in one table."""

    name: str
    required: list[str] = field(default_factory=list)
    ids: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    numbers: list[str] = field(default_factory=list)
    statuses: dict[str, list[str]] = field(default_factory=dict)
    critical: list[str] = field(default_factory=list)


# The five tables checked by default.
DEFAULT_SPECS = [
    QualitySpec(
        "custodian_balances.csv",
        required=["custodian_balance_id", "account_id", "balance_date", "custodian_cash_balance", "currency"],
        ids=["custodian_balance_id"], dates=["balance_date"], numbers=["custodian_cash_balance"]),
    QualitySpec(
        "reconciliation_breaks.csv",
        required=["break_id", "account_id", "business_date", "break_category", "dollar_exposure", "variance"],
        ids=["break_id"], dates=["business_date"],
        numbers=["internal_value", "custodian_value", "variance", "dollar_exposure"],
        statuses={"break_category": ["CASH_BALANCE_BREAK", "SHARE_QUANTITY_BREAK"]},
        critical=["account_id", "break_category", "dollar_exposure"]),
    QualitySpec(
        "exception_log.csv",
        required=["exception_id", "account_id", "business_date", "break_type", "severity", "variance_amount",
                  "root_cause", "status"],
        ids=["exception_id"], dates=["business_date", "detected_date", "due_date"],
        numbers=["variance_amount", "dollar_exposure", "aging_days"],
        statuses={"severity": ["HIGH", "MEDIUM", "LOW"],
                  "status": ["OPEN", "IN_REVIEW", "PENDING_VENDOR", "RESOLVED"]},
        critical=["account_id", "severity", "root_cause", "status"]),
    QualitySpec(
        "vendor_files.csv",
        required=["source_file_id", "file_name", "source_system", "receipt_status", "record_count", "expected_date"],
        ids=["source_file_id"], dates=["expected_date"], numbers=["record_count", "control_total"],
        statuses={"receipt_status": ["RECEIVED", "MISSING"],
                  "validation_status": ["VALIDATED", "FAILED", "PENDING"]}),
    QualitySpec(
        "raw_stock_transactions.csv",
        required=["ID", "Transaction Date", "Ticker", "No. of shares", "Price / share"],
        ids=["ID"], dates=["Transaction Date"], numbers=["No. of shares", "Price / share"]),
]


@dataclass
class _Check:
    """One check: how it counts, and what it says on failing and passing."""

    fail: tuple[str, str | Column, str | Column, str]  # name, severity, description, fix
    ok: tuple[str, str]  # name, description
    count: Column | None = None  # per-row condition counted in the shared aggregate
    scalar: Column | None = None  # count from a job of its own
    always: bool | None = None  # fixed outcome: True fails, False passes
    reported: str | int = 0  # count shown on a fixed failure; "rows" stands for the row count


def _n(count: Column) -> Column:
    return F.format_number(count, 0)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _count() -> Column:
    return F.col("failed_record_count")


def _null_required(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    out = []
    for c in spec.required:
        if c not in df.columns:
            out.append(_Check(
                ("MISSING_COLUMN", "HIGH", f"Required column '{c}' is absent from {spec.name}",
                 f"Confirm source query/export includes '{c}'"), ("", ""), always=True, reported="rows"))
            continue
        share = F.lit(100) * _count() / F.col("_rows")
        out.append(_Check(
            ("NULL_REQUIRED_FIELD", F.when(share > 10, "HIGH").otherwise("MEDIUM"),
             _text(f"'{c}' has ", _n(_count()), " null values (", F.format_number(share, 1),
                   f"% of rows) in {spec.name}"),
             f"Investigate upstream source for missing '{c}' values"),
            ("NULL_REQUIRED_FIELD", f"'{c}' — no nulls found"),
            count=quoted(c).isNull()))
    return out


def duplicate_row_count(df: DataFrame, column: str) -> DataFrame:
    """Rows that share their id with another row; empty ids count as equal."""
    repeated = df.groupBy(quoted(column).alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1")
    return repeated.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failed"))


def _duplicate_id(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    out = []
    for c in spec.ids:
        if c not in df.columns:
            out.append(_Check(("DUPLICATE_ID", "HIGH", f"ID column '{c}' not found in {spec.name}",
                               f"Ensure '{c}' is exported from the source"), ("", ""), always=True))
            continue
        out.append(_Check(
            ("DUPLICATE_ID", "HIGH", _text(f"'{c}' contains ", _n(_count()), f" duplicate values in {spec.name}"),
             f"Deduplicate on '{c}'; investigate source for re-sends or join issues"),
            ("DUPLICATE_ID", f"'{c}' — no duplicates found"),
            scalar=duplicate_row_count(df, c).scalar()))
    return out


def _unreadable(column: str, kind: str) -> Column:
    c = quoted(column)
    return c.isNotNull() & c.cast("string").try_cast(kind).isNull()


def _invalid_date(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    out = []
    for c in spec.dates:
        if c not in df.columns:
            out.append(_Check(("INVALID_DATE", "MEDIUM", f"Date column '{c}' not found in {spec.name}",
                               f"Confirm '{c}' is included in the export"), ("", ""), always=True))
            continue
        out.append(_Check(
            ("INVALID_DATE", "MEDIUM", _text(f"'{c}' has ", _n(_count()), f" unparseable date values in {spec.name}"),
             f"Standardise '{c}' to YYYY-MM-DD format at the source"),
            ("INVALID_DATE", f"'{c}' -- all dates parsed successfully"),
            count=_unreadable(c, "timestamp_ntz")))
    return out


def _non_numeric(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    out = []
    for c in spec.numbers:
        if c not in df.columns:
            out.append(_Check(("NON_NUMERIC_AMOUNT", "HIGH", f"Numeric column '{c}' not found in {spec.name}",
                               f"Ensure '{c}' is exported from the source"), ("", ""), always=True))
            continue
        out.append(_Check(
            ("NON_NUMERIC_AMOUNT", "HIGH", _text(f"'{c}' has ", _n(_count()), f" non-numeric values in {spec.name}"),
             f"Remove currency symbols, commas, or text from '{c}' before loading"),
            ("NON_NUMERIC_AMOUNT", f"'{c}' -- all values are numeric"),
            count=_unreadable(c, "double")))
    return out


def _missing_account(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    if "account_id" not in df.columns:
        return [_Check(("", "", "", ""),
                       ("MISSING_ACCOUNT_ID", "account_id column not applicable for this file"), always=False)]
    account = F.col("account_id")
    return [_Check(
        ("MISSING_ACCOUNT_ID", "HIGH", _text("account_id is null or zero for ", _n(_count()), f" rows in {spec.name}"),
         "Ensure account_id is populated from source before export"),
        ("MISSING_ACCOUNT_ID", "account_id -- no nulls or zero values found"),
        count=account.isNull() | (F.coalesce(account.cast("string").try_cast("double"), F.lit(1.0)) == 0))]


def _outside(column: str, allowed: list[str]) -> Column:
    c = quoted(column)
    return c.isNotNull() & ~F.upper(F.trim(c)).isin([v.upper() for v in allowed])


def _bad_code_sample(df: DataFrame, column: str, allowed: list[str], size: int = 5) -> Column:
    """The first few bad codes in text order, found by a bounded top-k rather than a whole set."""
    bad = df.where(_outside(column, allowed)).select(quoted(column).alias("_v")).distinct().orderBy("_v").limit(size)
    listed = F.concat(F.lit("['"), F.array_join(F.sort_array(F.collect_list("_v")), "', '"), F.lit("']"))
    return bad.agg(listed.alias("sample")).scalar()


def _invalid_status(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    out = []
    for c, allowed in spec.statuses.items():
        if c not in df.columns or not allowed:
            out.append(_Check(("", "", "", ""), (
                "INVALID_STATUS_VALUE", f"'{c}' -- column not present or no valid list defined"), always=False))
            continue
        out.append(_Check(
            ("INVALID_STATUS_VALUE", "MEDIUM",
             _text(f"'{c}' has ", _n(_count()), f" unexpected values in {spec.name}. Expected: {allowed}. Found (sample): ",
                   _bad_code_sample(df, c, allowed)),
             f"Standardise '{c}' values to the approved code list: {allowed}"),
            ("INVALID_STATUS_VALUE", f"'{c}' -- all values are within approved list"),
            count=_outside(c, allowed)))
    return out


def repeated_row_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column.

    Rows are grouped by a SHA-256 of an unambiguous text of all columns, so 32 bytes per row are
    shuffled instead of the row.
    """
    whole = F.to_json(F.struct(*[quoted(c) for c in df.columns]), {"ignoreNullFields": "false"})
    copies = df.groupBy(F.unhex(F.sha2(whole, 256)).alias("_row")).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failed"))


def _duplicate_rows(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    return [_Check(
        ("DUPLICATE_FULL_ROW", "MEDIUM", _text(_n(_count()), f" fully duplicate rows detected in {spec.name}"),
         "Deduplicate before loading; investigate whether the file was loaded twice"),
        ("DUPLICATE_FULL_ROW", "No fully duplicate rows found"),
        scalar=repeated_row_count(df).scalar())]


def _critical_null(df: DataFrame, spec: QualitySpec) -> list[_Check]:
    out = []
    for c in spec.critical:
        if c not in df.columns:
            out.append(_Check(("NULL_CRITICAL_FIELD", "HIGH", f"Critical field '{c}' is absent from {spec.name}",
                               f"Ensure '{c}' is present in the export"), ("", ""), always=True))
            continue
        out.append(_Check(
            ("NULL_CRITICAL_FIELD", "HIGH",
             _text(f"Critical field '{c}' is null for ", _n(_count()), f" rows in {spec.name}"),
             f"Populate '{c}' before loading -- this field is required for operational use"),
            ("NULL_CRITICAL_FIELD", f"'{c}' -- no nulls found in critical field"),
            count=quoted(c).isNull()))
    return out


# Check families in the order their results are listed.
FAMILIES = {
    "null_required": _null_required,
    "duplicate_id": _duplicate_id,
    "invalid_date": _invalid_date,
    "non_numeric": _non_numeric,
    "missing_account": _missing_account,
    "invalid_status": _invalid_status,
    "duplicate_rows": _duplicate_rows,
    "critical_null": _critical_null,
}


def _run(df: DataFrame, spec: QualitySpec, checks: list[_Check], first_id: int) -> DataFrame:
    counted = {f"_c{i}": F.count_if(c.count) for i, c in enumerate(checks) if c.count is not None}
    totals = df.agg(F.count("*").alias("_rows"), *[c.alias(k) for k, c in counted.items()])

    def column(x: str | Column) -> Column:
        return x if isinstance(x, Column) else F.lit(x)

    rows = []
    for i, check in enumerate(checks):
        if check.count is not None:
            failed = F.col(f"_c{i}")
        elif check.scalar is not None:
            failed = check.scalar
        else:
            failed = F.col("_rows") if check.reported == "rows" else F.lit(0)
        rows.append(F.struct(F.lit(i).alias("_check"), failed.cast("bigint").alias("failed_record_count")))
    found = totals.select("_rows", F.inline(F.array(*rows)))
    name, severity, description, fix = range(4)

    def outcome(check: _Check, passing: tuple, fixed_fail: bool) -> Column:
        texts = (*check.fail, "FAIL") if fixed_fail else passing
        return F.struct(*[column(t).alias(f"_{k}") for k, t in enumerate(texts)])

    said = None
    for i, check in enumerate(checks):
        passing = (check.ok[0], "INFO", check.ok[1], _PASS_FIX, "PASS")
        if check.always is None:
            says = F.when(_count() > 0, outcome(check, passing, True)).otherwise(outcome(check, passing, False))
        else:
            says = outcome(check, passing, check.always)
        hit = F.col("_check") == i
        said = F.when(hit, says) if said is None else said.when(hit, says)
    part = lambda k: F.col("_said").getField(f"_{k}")
    return found.withColumn("_said", said).select(
        (F.col("_check") + first_id).cast("bigint").alias("check_id"), F.lit(spec.name).alias("input_file"),
        part(name).alias("check_name"), part(4).alias("check_status"), "failed_record_count",
        part(severity).alias("severity"), part(description).alias("issue_description"), part(fix).alias("suggested_fix"))


def table_checks(df: DataFrame, spec: QualitySpec, families: list[str] | None = None,
                 first_id: int = 1) -> tuple[DataFrame, int]:
    """Results of the chosen families for one table, and the next free check id."""
    checks = [c for name in (families or FAMILIES) for c in FAMILIES[name](df, spec)]
    return _run(df, spec, checks, first_id), first_id + len(checks)


def _not_found(spark: SparkSession, spec: QualitySpec, check_id: int) -> DataFrame:
    values = ("FILE_NOT_FOUND", "FAIL", 0, "HIGH", f"{spec.name} was not found",
              "Confirm the file path and re-run the pipeline export")
    kinds = ["string", "string", "bigint", "string", "string", "string"]
    return literal_frame(spark, [(check_id, spec.name, *values)], [
        ("check_id", "bigint"), ("input_file", "string"), *zip(_RESULT, kinds)])


def dq_suite(spark: SparkSession, tables: list[tuple[QualitySpec, DataFrame | None]]) -> DataFrame:
    """All checks of all tables with running ids; a missing table gives one failing row."""
    out, next_id = None, 1
    for spec, df in tables:
        if df is None:
            part, next_id = _not_found(spark, spec, next_id), next_id + 1
        else:
            part, next_id = table_checks(df, spec, first_id=next_id)
        out = part if out is None else out.unionByName(part)
    return out


def dq_pass_rate(results: DataFrame) -> DataFrame:
    failed = F.col("check_status") == "FAIL"
    by = lambda s: F.count_if(failed & (F.col("severity") == s))
    total = F.count("*")
    return results.agg(
        total.alias("total_checks"), F.count_if(failed).alias("failed_checks"),
        F.when(total > 0, F.round(F.lit(100.0) * F.count_if(~failed) / F.greatest(total, F.lit(1)), 1))
        .otherwise(0.0).alias("pass_rate"),
        by("HIGH").alias("failed_high"), by("MEDIUM").alias("failed_medium"), by("LOW").alias("failed_low"))


def column_profile(df: DataFrame, exact: bool = True, samples: int = 3) -> DataFrame:
    """Per column: nulls, null share, distinct values, a few sample values, negative numbers.

    Each row becomes (column number, value) cells, which every task counts per value before they are
    shuffled, once: the counts and the samples of a column both start from the counted cells, and only a
    few rows a task and column go on from there. So neither a frequent value nor a wide column ends in one task. With
    ``exact`` off, distinct counts are sketched in a single pass over the rows.
    """
    names = df.columns
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), quoted(n).cast("string").alias("value")) for i, n in enumerate(names)])
    long = df.select(F.inline(cells))
    negative = F.coalesce(F.col("value").try_cast("double"), F.lit(0.0)) < 0
    if exact:
        values = long.groupBy("_column", "value").agg(F.count("*").alias("_n"))
        present = F.col("value").isNotNull()
        stats = values.groupBy("_column").agg(
            F.sum("_n").alias("row_count"),
            F.coalesce(F.sum(F.when(~present, F.col("_n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("unique_values"),
            F.coalesce(F.sum(F.when(negative, F.col("_n"))), F.lit(0)).alias("negative_count"))
    else:
        values = long.distinct().withColumn("_n", F.lit(1))
        stats = long.groupBy("_column").agg(
            F.count("*").alias("row_count"), F.count_if(F.col("value").isNull()).alias("null_count"),
            F.approx_count_distinct("value").alias("unique_values"), F.count_if(negative).alias("negative_count"))
    # A rank limit below the shuffle keeps only the first few values of a column per task. Nulls come last and
    # are dropped after it, and the count takes part in the order: so this reads the very cells that the counts read.
    first = Window.partitionBy("_column").orderBy(F.col("value").asc_nulls_last(), "_n")
    sample = (values.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= samples)
              .groupBy("_column").agg(F.array_join(F.sort_array(F.collect_list("value")), ", ").alias("sample_values")))
    none_seen = F.when(F.col("null_count") < F.col("row_count"), F.col("sample_values"))
    return stats.join(sample, "_column", "left").select(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_column") + 1).alias("column_name"), "row_count", "null_count",
        F.round(F.lit(100.0) * F.col("null_count") / F.col("row_count"), 2).alias("null_pct"),
        "unique_values", none_seen.alias("sample_values"), "negative_count")
