"""Exception log: severity, cause, owner, status and SLA of every break."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import MONEY, SHARES, label_ladder, lookup, money
from ledgerloom.operators.ids import ordered_id
from ledgerloom.sources.schemas import EXCEPTION_LOG
from ledgerloom.sources.workspace import Workspace

# Matched causes in order of preference, for logs that keep one row per break.
_MATCH_ORDER = ["MISSING_IN_CUSTODIAN", "DUPLICATE_TRANSACTION", "TIMING_DIFFERENCE"]


def severity(exposure: Column, steps: list[tuple] = fixed.SEVERITY_LADDER,
             floor: str = fixed.SEVERITY_FLOOR) -> Column:
    return label_ladder(exposure, steps, floor)


def rule_cause(category: Column, variance: Column, bands: list[tuple] = fixed.CASH_CAUSE_BANDS) -> Column:
    """Cause by break category, and by size for cash breaks."""
    size = F.abs(variance)
    by_size = F.lit(None).cast("string")
    for low, high, low_in, high_in, cause in reversed(bands):
        hit = F.lit(True)
        if low is not None:
            hit = hit & (size >= money(low) if low_in else size > money(low))
        if high is not None:
            hit = hit & (size <= money(high) if high_in else size < money(high))
        by_size = F.when(hit, cause).otherwise(by_size)
    return F.when(category == "CASH_BALANCE_BREAK", by_size).otherwise(
        lookup(category, fixed.CATEGORY_CAUSES, fixed.DEFAULT_CAUSE))


def owner(category: Column, owners: dict[str, str] = fixed.OWNERS, default: str = fixed.DEFAULT_OWNER) -> Column:
    return lookup(category, owners, default)


def _cycle(break_id: Column, pick: int) -> Column:
    """Entry ``pick`` of the status step that the break id's last digit falls in."""
    digit = F.pmod(break_id, F.lit(fixed.STATUS_CYCLE))
    out = F.lit(fixed.STATUS_STEPS[-1][pick])
    for below, *entries in reversed(fixed.STATUS_STEPS[:-1]):
        out = F.when(digit < below, entries[pick - 1]).otherwise(out)
    return out


def status(break_id: Column) -> Column:
    return _cycle(break_id, 1)


def resolution_notes(break_id: Column) -> Column:
    return _cycle(break_id, 2)


def aging_days(business_date: Column, review_date: str = fixed.REVIEW_DATE) -> Column:
    return F.date_diff(F.lit(review_date).cast("date"), business_date)


def sla_status(status_column: Column, aging: Column, sla_days: int = fixed.SLA_DAYS) -> Column:
    return F.when((status_column == "RESOLVED") | (aging <= sla_days), "WITHIN_SLA").otherwise("OVER_SLA")


def with_status(breaks: DataFrame, review_date: str = fixed.REVIEW_DATE) -> DataFrame:
    """Breaks with status, dates, age, SLA and note."""
    day, number = F.col("business_date"), F.col("break_id")
    return breaks.withColumns({
        "status": status(number),
        "detected_date": F.lit(review_date).cast("date"),
        "due_date": F.date_add(day, fixed.SLA_DAYS),
        "aging_days": aging_days(day, review_date),
        "sla_status": sla_status(status(number), aging_days(day, review_date)),
        "resolution_notes": resolution_notes(number),
    })


def with_root_cause(breaks: DataFrame, matches: DataFrame, dedupe: bool = False) -> DataFrame:
    """Breaks with the cause of a matching transaction, else by rule.

    A break that several transactions explain appears once per match; ``dedupe`` keeps the most
    telling cause only.
    """
    causes = matches.select("account_id", "business_date", F.col("cash_variance").cast(SHARES).alias("variance"),
                            "inferred_root_cause")
    if dedupe:
        listed = F.array(*[F.lit(c) for c in _MATCH_ORDER])
        best = F.min(F.array_position(listed, F.col("inferred_root_cause"))).cast("int")
        causes = causes.groupBy("account_id", "business_date", "variance").agg(
            F.get(listed, best - 1).alias("inferred_root_cause"))
    return breaks.join(causes, ["account_id", "business_date", "variance"], "left").withColumn(
        "root_cause", F.coalesce("inferred_root_cause", rule_cause(F.col("break_category"), F.col("variance")))
    ).drop("inferred_root_cause")


def exception_log(breaks: DataFrame, matches: DataFrame, review_date: str = fixed.REVIEW_DATE,
                  dedupe: bool = False) -> DataFrame:
    """One exception per break (and match), without evidence and without ids."""
    exposure = F.col("dollar_exposure")
    return with_status(with_root_cause(breaks, matches, dedupe), review_date).select(
        "break_id", "business_date", "account_id", "ticker", F.col("break_category").alias("break_type"),
        severity(exposure).alias("severity"), "internal_value", "custodian_value",
        F.col("variance").alias("variance_amount"), "dollar_exposure", "root_cause",
        owner(F.col("break_category")).alias("owner"), "status", "detected_date", "due_date", "aging_days",
        "sla_status", "resolution_notes", F.lit(None).cast("string").alias("evidence_file"),
    )


def reclassify(log: DataFrame, ticker: str = fixed.OVERSTATED_TICKER,
               cause: str = fixed.OVERSTATED_TICKER_CAUSE) -> DataFrame:
    """Share breaks of one ticker get a cause of their own."""
    hit = (F.col("break_type") == "SHARE_QUANTITY_BREAK") & (F.col("ticker") == ticker) & F.col("break_id").isNotNull()
    return log.withColumn("root_cause", F.when(hit, cause).otherwise(F.col("root_cause")))


def assign_evidence(log: DataFrame, evidence: dict[str, str] = fixed.EVIDENCE,
                    default: str = fixed.DEFAULT_EVIDENCE) -> DataFrame:
    """Fill empty evidence by root cause."""
    found = lookup(F.col("root_cause"), evidence, default)
    blank = F.col("evidence_file").isNull() | (F.trim("evidence_file") == "")
    return log.withColumn("evidence_file", F.when(blank, found).otherwise(F.col("evidence_file")))


def control_exceptions(log: DataFrame, adjustments: DataFrame, review_date: str = fixed.REVIEW_DATE) -> DataFrame:
    """Exceptions for faults that leave no break, unless the log has that cause on that day.

    Input adjustments: exception_type, affected_date, account_id.
    """
    kinds = fixed.CONTROL_EXCEPTIONS
    cause = lookup(F.col("exception_type"), {k: v[0] for k, v in kinds.items()}, F.lit(None).cast("string"))
    note = lookup(F.col("exception_type"), {k: v[1] for k, v in kinds.items()}, F.lit(None).cast("string"))
    candidates = adjustments.where(F.col("exception_type").isin(*kinds)).withColumns(
        {"root_cause": cause, "resolution_notes": note, "business_date": F.col("affected_date")})
    causes = [v[0] for v in kinds.values()]
    known = log.where(F.col("root_cause").isin(*causes)).select("root_cause", "business_date").distinct()
    zero = F.lit(0).cast(SHARES)
    return candidates.join(known, ["root_cause", "business_date"], "left_anti").select(
        F.lit(None).cast("bigint").alias("break_id"), "business_date",
        F.coalesce("account_id", F.lit(1)).cast("bigint").alias("account_id"),
        F.lit(None).cast("string").alias("ticker"), F.col("root_cause").alias("break_type"),
        F.lit("HIGH").alias("severity"), zero.alias("internal_value"), zero.alias("custodian_value"),
        zero.alias("variance_amount"), F.lit(0).cast(MONEY).alias("dollar_exposure"), "root_cause",
        F.lit(fixed.CONTROL_OWNER).alias("owner"), F.lit("RESOLVED").alias("status"),
        F.lit(review_date).cast("date").alias("detected_date"),
        F.date_add("business_date", fixed.CONTROL_SLA_DAYS).alias("due_date"),
        aging_days(F.col("business_date"), review_date).alias("aging_days"),
        F.lit("WITHIN_SLA").alias("sla_status"), "resolution_notes",
        lookup(F.col("root_cause"), fixed.EVIDENCE, fixed.DEFAULT_EVIDENCE).alias("evidence_file"),
    )


def complete_log(breaks: DataFrame, matches: DataFrame, adjustments: DataFrame, workspace: Workspace,
                 review_date: str = fixed.REVIEW_DATE, ticker: str = fixed.OVERSTATED_TICKER,
                 dedupe: bool = False, start: int = 0) -> DataFrame:
    """The whole exception log, control-level rows last, with consecutive exception ids."""
    log = assign_evidence(reclassify(exception_log(breaks, matches, review_date, dedupe), ticker))
    extra = control_exceptions(log, adjustments, review_date)
    whole = log.withColumn("_appended", F.lit(0)).unionByName(extra.withColumn("_appended", F.lit(1)))
    order = ["_appended", "break_id", "root_cause", "business_date", "account_id"]
    numbered = ordered_id(whole, order, "exception_id", workspace, start)
    return numbered.select(*EXCEPTION_LOG.fieldNames())
