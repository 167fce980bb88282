"""Reporting aggregates. All group with a partial sum ahead of the shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import SHARES, match_key

_SEC = "security_impact"
_CASH = "cash_impact"


def _typed(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    names = mapping.select(match_key(F.col("raw_action")).alias("_type"), "standardized_category")
    return (facts.withColumn("_type", match_key(F.col("transaction_type")))
            .join(names, "_type", "left").drop("_type"))


def cash_activity(cash: DataFrame, accounts: DataFrame, mapping: DataFrame) -> DataFrame:
    return _typed(cash.join(accounts.select("account_id", "account_type"), "account_id"), mapping).select(
        "transaction_id", "source_transaction_id", "account_id", "account_type", "transaction_date",
        "transaction_type", "standardized_category", F.col("currency_total").alias("currency"), "cash_impact",
        F.col("total_amount").alias("gross_amount"), "withholding_tax", "charge_amount", "stamp_duty", "notes")


def security_activity(trades: DataFrame, accounts: DataFrame, securities: DataFrame,
                      mapping: DataFrame) -> DataFrame:
    joined = (trades.join(accounts.select("account_id", "account_type"), "account_id")
              .join(securities.select("ticker", "security_name"), "ticker"))
    return _typed(joined, mapping).select(
        "transaction_id", "source_transaction_id", "account_id", "account_type", "transaction_date", "ticker",
        "security_name", "transaction_type", "standardized_category", "security_impact",
        F.col("shares").alias("absolute_shares"), "price_per_share", "currency_price", "realized_result")


def exception_summary(breaks: DataFrame, log: DataFrame) -> DataFrame:
    """Breaks by category and exception state. Control-level exceptions have no break and stay out."""
    state = log.select("break_id", "root_cause", "severity", "status", "sla_status")
    return (
        breaks.select("break_id", "break_category", "variance", "dollar_exposure")
        .join(state, "break_id", "left")
        .groupBy("break_category", "root_cause", "severity", "status", "sla_status")
        .agg(F.count("*").alias("exception_count"), F.sum(F.abs("variance")).alias("absolute_variance"),
             F.sum("dollar_exposure").alias("dollar_exposure"))
    )


def recon_summary(breaks: DataFrame) -> DataFrame:
    return breaks.groupBy("business_date", "break_category").agg(
        F.count("*").alias("total_breaks"), F.sum(F.abs("variance")).alias("total_absolute_variance"),
        F.sum("dollar_exposure").alias("total_dollar_exposure"))


def exposure_summary(adjustments: DataFrame, breaks: DataFrame, log: DataFrame) -> DataFrame:
    """Four labelled totals; the two log totals come from one pass."""
    wide = "decimal(38,8)"
    names = [F.struct(F.lit(m).alias("exposure_metric"), F.lit(d).alias("definition")) for m, d in fixed.EXPOSURE_ROWS]
    row = lambda i, total: F.struct(names[i].getField("exposure_metric").alias("exposure_metric"),
                                    names[i].getField("definition").alias("definition"),
                                    total.cast(wide).alias("total_value"))
    injected = adjustments.agg(row(0, F.sum(F.abs(F.coalesce(
        F.col("impact_amount").cast(SHARES), "impact_shares")))).alias("r")).select("r.*")
    daily = breaks.agg(row(1, F.sum("dollar_exposure")).alias("r")).select("r.*")
    still_open = F.when(F.col("status").isin(*fixed.OPEN_STATUSES), F.col("dollar_exposure"))
    both = log.agg(F.array(row(2, F.sum("dollar_exposure")), row(3, F.sum(still_open))).alias("rows")).select(
        F.inline("rows"))
    return injected.unionByName(daily).unionByName(both)


def root_cause_breakdown(log: DataFrame) -> DataFrame:
    return (log.groupBy("root_cause").agg(F.count("*").alias("break_count"))
            .orderBy(F.desc("break_count"), "root_cause"))


def cash_break_causes(breaks: DataFrame, log: DataFrame) -> DataFrame:
    cash = breaks.where("break_category = 'CASH_BALANCE_BREAK'")
    return (
        cash.join(log.select("break_id", "root_cause"), "break_id", "left")
        .groupBy("break_category", "root_cause")
        .agg(F.count("*").alias("break_count"), F.sum("variance").alias("net_cash_variance"),
             F.sum(F.abs("variance")).alias("absolute_cash_variance"))
        .orderBy(F.desc("absolute_cash_variance"), "root_cause")
    )


def _share_breaks(breaks: DataFrame) -> DataFrame:
    return breaks.where("break_category = 'SHARE_QUANTITY_BREAK'")


_SHARE_SUMS = lambda: [F.sum("variance").alias("net_share_variance"),
                       F.sum(F.abs("variance")).alias("absolute_share_variance")]


def share_break_tickers(breaks: DataFrame) -> DataFrame:
    return (_share_breaks(breaks).groupBy("ticker").agg(F.count("*").alias("break_count"), *_SHARE_SUMS())
            .orderBy(F.desc("absolute_share_variance"), "ticker"))


def share_break_runs(breaks: DataFrame) -> DataFrame:
    return (
        _share_breaks(breaks).groupBy("account_id", "ticker")
        .agg(F.min("business_date").alias("first_break_date"), F.max("business_date").alias("last_break_date"),
             F.count("*").alias("break_days"), *_SHARE_SUMS())
        .orderBy(F.desc("break_days"), "account_id", "ticker")
    )


def _profile(facts: DataFrame, keys: list[str], impact: str, noun: str) -> DataFrame:
    return facts.groupBy(*keys).agg(
        F.count("*").alias("transaction_count"), F.sum(impact).alias(f"total_{noun}_impact"),
        F.min(impact).alias(f"min_{noun}_impact"), F.max(impact).alias(f"max_{noun}_impact"))


def cash_type_profile(cash: DataFrame) -> DataFrame:
    return _profile(cash, ["transaction_type"], _CASH, "cash").orderBy(
        F.desc("transaction_count"), "transaction_type")


def security_type_profile(trades: DataFrame) -> DataFrame:
    return _profile(trades, ["transaction_type", "ticker"], _SEC, "security").orderBy(
        "transaction_type", F.desc("transaction_count"), "ticker")


def _status_count(name: str) -> Column:
    return F.count_if(F.col("status") == name)


def kpi_cards(log: DataFrame, rollforward: DataFrame, validation: DataFrame) -> DataFrame:
    """Headline figures in one row; the log is read once."""
    failures = rollforward.agg(F.count("*")).scalar()
    tested = validation.agg(F.count("*")).scalar()
    detected = validation.agg(F.count_if(F.col("detection_status") == "DETECTED")).scalar()
    return log.agg(
        F.count("exception_id").alias("total_exceptions"),
        _status_count("OPEN").alias("open_count"), _status_count("IN_REVIEW").alias("in_review_count"),
        _status_count("PENDING_VENDOR").alias("pending_vendor_count"),
        _status_count("RESOLVED").alias("resolved_count"),
        F.count_if(F.col("sla_status") == "OVER_SLA").alias("over_sla_count"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count"),
        F.sum("dollar_exposure").alias("total_exposure"),
        F.count_distinct("root_cause").alias("distinct_root_causes"),
    ).withColumns({
        "ledger_failures": failures,
        "injections_tested": tested,
        "detection_rate": F.when(tested == 0, F.lit(1.0)).otherwise(detected / F.greatest(tested, F.lit(1))),
    })


def _count_and_exposure(log: DataFrame, *keys) -> DataFrame:
    return log.groupBy(*keys).agg(F.count("*").alias("exception_count"),
                                  F.sum("dollar_exposure").alias("dollar_exposure"))


def root_cause_exposure(log: DataFrame) -> DataFrame:
    return _count_and_exposure(log, "root_cause")


def owner_mix(log: DataFrame) -> DataFrame:
    return log.groupBy("owner").agg(F.count("*").alias("exception_count"))


def status_mix(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("exception_count"))


def exception_aging(log: DataFrame) -> DataFrame:
    return log.groupBy("sla_status", "severity", "root_cause").agg(F.sum("dollar_exposure").alias("dollar_exposure"))


def aging_bucket(days: Column) -> Column:
    out = F.lit(fixed.AGING_BUCKET_LAST)
    for upto, label in reversed(fixed.AGING_BUCKETS):
        out = F.when(days <= upto, label).otherwise(out)
    return out


def aging_buckets(log: DataFrame) -> DataFrame:
    return _count_and_exposure(log, aging_bucket(F.col("aging_days")).alias("aging_bucket"))


def open_by_owner(log: DataFrame) -> DataFrame:
    return _count_and_exposure(log.where("status <> 'RESOLVED'"), "owner")


def cause_status_pivot(log: DataFrame, statuses: list[str] = fixed.ALL_STATUSES) -> DataFrame:
    """Causes by status. The status list is given, so no extra job looks for it."""
    return log.groupBy("root_cause").pivot("status", statuses).count().na.fill(0)


def control_status(cash_breaks: Column, share_breaks: Column, over_sla: Column, missing_files: Column,
                   unmapped: Column, rollforward_failures: Column, null_fields: Column, orphans: Column,
                   criticals: Column, causeless: Column, one_row: DataFrame) -> DataFrame:
    """Control list with PASS or the failing text, from one failure count per control."""
    counts = [cash_breaks, share_breaks, over_sla, missing_files, unmapped, rollforward_failures, null_fields,
              orphans, criticals, causeless]
    rows = [
        F.struct(F.lit(c[0]).alias("control_id"), F.lit(c[1]).alias("control_name"),
                 F.lit(c[2]).alias("process_area"), F.lit(c[3]).alias("frequency"), F.lit(c[4]).alias("owner"),
                 F.when(n > 0, c[5]).otherwise("PASS").alias("status"))
        for c, n in zip(fixed.CONTROLS, counts, strict=True)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def dashboard_measures(cash: DataFrame, trades: DataFrame, breaks: DataFrame, log: DataFrame,
                       controls: DataFrame, quality: DataFrame, vendor: DataFrame,
                       anomalies: DataFrame) -> DataFrame:
    """Headline measures as one row."""
    count = lambda df: df.agg(F.count("*")).scalar()
    rate = lambda df, good: df.agg(
        F.round(F.lit(100.0) * F.count_if(good) / F.greatest(F.count("*"), F.lit(1)), 1)).scalar()
    accounts = (cash.select("account_id").union(trades.select("account_id"))
                .agg(F.count_distinct("account_id")).scalar())
    return log.agg(
        F.count("*").alias("total_exceptions"),
        F.count_if(F.col("status") != "RESOLVED").alias("open_exceptions"),
        F.count_if(F.col("sla_status") == "OVER_SLA").alias("breaks_over_sla"),
        F.sum("dollar_exposure").alias("dollar_exposure"),
        F.round(F.sum("aging_days").cast("double") / F.count("aging_days"), 6).alias("average_exception_age"),
    ).withColumns({
        "total_transactions": count(cash) + count(trades),
        "accounts_reviewed": accounts,
        "total_breaks": count(breaks),
        "control_pass_rate": rate(controls, F.col("status") == "PASS"),
        "data_quality_pass_rate": rate(quality, F.col("check_status") == "PASS"),
        "vendor_issue_count": count(vendor),
        "anomaly_count": count(anomalies),
        "high_risk_anomaly_count": anomalies.agg(F.count_if(F.col("severity") == "HIGH")).scalar(),
    })
