"""Anomaly rules on balances, breaks, exceptions and transactions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import as_day, as_number, first_present, literal_frame, lookup
from ledgerloom.functions.sizing import small_side
from ledgerloom.operators.ids import ordered_id, previous_value
from ledgerloom.operators.ranks import group_quantiles
from ledgerloom.sources.schemas import ANOMALY_FLAGS
from ledgerloom.sources.workspace import Workspace

def standard_balances(df: DataFrame, date_column: str | None, balance_column: str) -> DataFrame:
    """Account, day and balance under fixed names, unreadable values as missing."""
    day = as_day(df, date_column) if date_column else F.lit(None).cast("date")
    return df.select("account_id", day.alias("day"), as_number(df, balance_column).alias("balance"))


def _flag(kind, severity, reason, action, source: str, *, account="account_id", txn=None, day=None, amount=None,
          balance=None, threshold=None, rank=None) -> Column:
    """Flag fields in the common layout, led by a rank within the rule for ordering."""
    given = {"account_id": account, "transaction_id": txn, "transaction_date": day, "anomaly_type": kind,
             "amount": amount, "balance": balance, "threshold_value": threshold, "severity": severity,
             "reason_code": reason, "review_action": action, "source_file": source}
    names = {"account_id", "transaction_id", "transaction_date", "amount", "balance"}
    fields = [(F.lit(0) if rank is None else F.col(rank)).alias("_rank")]
    for f in ANOMALY_FLAGS:
        x = given[f.name]
        c = x if isinstance(x, Column) else F.col(x) if f.name in names and x is not None else F.lit(x)
        fields.append(c.cast(f.dataType).alias(f.name))
    return F.struct(*fields)


def _flags(rows: DataFrame, *found: Column) -> DataFrame:
    """Flags of all given rules from one scan; a rule that does not fire is null."""
    if len(found) == 1:
        return rows.select(found[0].alias("_flag")).where("_flag is not null").select("_flag.*")
    return rows.select(F.inline(F.array_compact(F.array(*found))))


def flags(found: DataFrame) -> DataFrame:
    """A rule's flags without the ordering column."""
    return found.select(*ANOMALY_FLAGS.fieldNames())


# Fixed values: (type, reason code, review action) of the balance rules, per book.
_CUSTODIAN = "custodian_balances.csv"
_LEDGER = "internal_ledger.csv"
_NEGATIVE = {
    _CUSTODIAN: ("NEGATIVE_CASH_BALANCE", "BALANCE_BELOW_ZERO",
                 "Investigate funding entries and custodian adjustments"),
    _LEDGER: ("LEDGER_NEGATIVE_BALANCE", "LEDGER_BALANCE_BELOW_ZERO",
              "Investigate internal ledger funding or settlement entry"),
}
_EXCESS = {
    _CUSTODIAN: ("EXCESS_CASH_BALANCE", "BALANCE_ABOVE_THRESHOLD",
                 "Confirm balance is expected; check for uninvested cash or posting errors"),
    _LEDGER: ("LEDGER_EXCESS_BALANCE", "LEDGER_BALANCE_ABOVE_THRESHOLD", "Confirm internal ledger balance is expected"),
}
_MOVEMENT = {
    _CUSTODIAN: ("LARGE_DAILY_CASH_MOVEMENT", "DAILY_CHANGE_EXCEEDS_THRESHOLD",
                 "Verify funding wires, settlement activity, and journal entries for this date"),
    _LEDGER: ("LEDGER_LARGE_DAILY_MOVEMENT", "LEDGER_DAILY_CHANGE_EXCEEDS_THRESHOLD",
              "Verify internal ledger movement against custodian balance"),
}


# The order in which rules list their flags; both outlier tests are one rule.
_RULE_ORDER = {
    "NEGATIVE_CASH_BALANCE": 0, "EXCESS_CASH_BALANCE": 1, "LARGE_DAILY_CASH_MOVEMENT": 2,
    "STATISTICAL_OUTLIER_Z_SCORE": 3, "STATISTICAL_OUTLIER_IQR": 3, "HIGH_BREAK_CONCENTRATION_ACCOUNT": 4,
    "HIGH_BREAK_CONCENTRATION_CATEGORY": 5, "HIGH_EXCEPTION_CONCENTRATION": 6, "LARGE_CASH_TRANSACTION": 7,
    "LEDGER_NEGATIVE_BALANCE": 8, "LEDGER_EXCESS_BALANCE": 9, "LEDGER_LARGE_DAILY_MOVEMENT": 10,
}


def _negative(source: str, warn: float, high: float) -> Column:
    kind, reason, action = _NEGATIVE[source]
    severity = F.when(F.col("balance") < high, "HIGH").otherwise("MEDIUM")
    return F.when(F.col("balance") < warn, _flag(
        kind, severity, reason, action, source, day="day", balance="balance", threshold=warn))


def _excess(source: str, limit: float) -> Column:
    kind, reason, action = _EXCESS[source]
    return F.when(F.col("balance") > limit, _flag(
        kind, "MEDIUM", reason, action, source, day="day", balance="balance", threshold=limit))


def negative_balances(balances: DataFrame, source: str = _CUSTODIAN, warn: float = fixed.NEGATIVE_BALANCE_WARN,
                      high: float = fixed.NEGATIVE_BALANCE_HIGH) -> DataFrame:
    return _flags(balances.where(F.col("balance") < warn), _negative(source, warn, high))


def excess_cash(balances: DataFrame, source: str = _CUSTODIAN, limit: float = fixed.EXCESS_CASH) -> DataFrame:
    return _flags(balances.where(F.col("balance") > limit), _excess(source, limit))


def level_flags(balances: DataFrame, source: str = _CUSTODIAN, excess: float = fixed.EXCESS_CASH,
                warn: float = fixed.NEGATIVE_BALANCE_WARN, high: float = fixed.NEGATIVE_BALANCE_HIGH) -> DataFrame:
    """Negative and excess balances from one scan."""
    return _flags(balances.where((F.col("balance") < warn) | (F.col("balance") > excess)),
                  _negative(source, warn, high), _excess(source, excess))


def daily_changes(balances: DataFrame, workspace: Workspace) -> DataFrame:
    """Absolute change of every balance from the account's previous one.

    Equal balances of one day follow each other, so copies change nothing and are folded into one
    row before the shuffle. Rows are then cut evenly by range, through an account where need be.
    """
    present = balances.where("account_id is not null and day is not null and balance is not null")
    folded = present.groupBy("account_id", "day", "balance").agg(F.count("*").alias("copies"))
    seen = previous_value(folded, "account_id", ["day", "balance"], "balance", "previous", workspace)
    return seen.select("account_id", "day", "balance", F.abs(F.col("balance") - F.col("previous")).alias("change"))


def large_movements(balances: DataFrame, workspace: Workspace, source: str = _CUSTODIAN,
                    limit: float = fixed.LARGE_MOVEMENT) -> DataFrame:
    if limit < 0:
        raise ValueError("a movement limit cannot be negative")
    kind, reason, action = _MOVEMENT[source]
    return _flags(daily_changes(balances, workspace).where(F.col("change") > limit), _flag(
        kind, "HIGH", reason, action, source, day="day", amount="change", balance="balance", threshold=limit))


def _measured(balances: DataFrame) -> DataFrame:
    present = balances.where("account_id is not null and balance is not null")
    return present.withColumn("x", F.col("balance").cast("double"))


def account_moments(balances: DataFrame) -> DataFrame:
    """Rows, mean and deviation per account, from one pass with partial sums."""
    return _measured(balances).groupBy("account_id").agg(
        F.count("*").alias("n"), (F.sum("balance").cast("double") / F.count("*")).alias("mean"), F.stddev_pop("x").alias("deviation"))


def account_quartiles(balances: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows and exact quartiles with linear interpolation per account, of any size and by one path."""
    found = group_quantiles(_measured(balances), "account_id", "x", [0.25, 0.75], workspace)
    return found.select("account_id", "n", F.get("quantiles", F.lit(0)).alias("q1"), F.get("quantiles", F.lit(1)).alias("q3"))


def z_scores(balances: DataFrame, workspace: Workspace, min_rows: int = fixed.MIN_GROUP_ROWS) -> DataFrame:
    """Every balance with its z-score within the account; 0 in short and in flat accounts.

    Account figures are written once. If counting shows them small they are broadcast and the
    balances stay where they are; otherwise they meet in a shuffle join that splits hot accounts.
    """
    moments = workspace.write(account_moments(balances), "account-moments")
    z = F.when((F.col("n") >= min_rows) & (F.col("deviation") != 0),
               (F.col("x") - F.col("mean")) / F.col("deviation")).otherwise(0.0)
    return _measured(balances).join(small_side(moments), "account_id").select("account_id", "day", "balance", "x", z.alias("z_score"))


def account_outliers(balances: DataFrame, workspace: Workspace, z_limit: float = fixed.Z_SCORE,
                     iqr_multiplier: float = fixed.IQR_MULTIPLIER,
                     min_rows: int = fixed.MIN_GROUP_ROWS) -> DataFrame:
    """Every balance with its z-score and whether it leaves the account's Tukey fences."""
    quartiles = workspace.write(account_quartiles(balances, workspace).where(F.col("n") >= min_rows).drop("n"), "account-quartiles")
    spread = F.col("q3") - F.col("q1")
    outside = (F.col("x") < F.col("q1") - F.lit(iqr_multiplier) * spread) | (
        F.col("x") > F.col("q3") + F.lit(iqr_multiplier) * spread)
    return z_scores(balances, workspace, min_rows).join(small_side(quartiles), "account_id", "left").select(
        "account_id", "day", "balance", "z_score", (F.abs("z_score") > z_limit).alias("z_outlier"),
        F.coalesce((spread != 0) & outside, F.lit(False)).alias("iqr_outlier"))


def statistical_outliers(outliers: DataFrame, z_limit: float = fixed.Z_SCORE,
                         iqr_multiplier: float = fixed.IQR_MULTIPLIER) -> DataFrame:
    """One flag per balance that either test finds; the z-score names it when both do."""
    method = F.when(F.col("z_outlier"), "Z_SCORE").otherwise("IQR")
    threshold = F.round(F.when(F.col("z_outlier"), F.lit(float(z_limit))).otherwise(float(iqr_multiplier)), 2)
    return _flags(outliers.where("z_outlier or iqr_outlier"), _flag(
        F.concat(F.lit("STATISTICAL_OUTLIER_"), method), "LOW",
        F.concat(F.lit("BALANCE_IS_ACCOUNT_RELATIVE_OUTLIER_"), method),
        "Secondary review -- confirm balance is operationally expected for this account", _CUSTODIAN,
        day="day", balance="balance", threshold=threshold))


def _top(grouped: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The n largest groups, ties to the first in key order; ranked after the cut, so over n rows."""
    best = grouped.orderBy(F.desc(measure), key).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(measure), key)))


def break_concentration_account(breaks: DataFrame, n: int = fixed.CONCENTRATION_TOP_N) -> DataFrame:
    rows = breaks.where("dollar_exposure is not null and account_id is not null")
    top = _top(rows.groupBy("account_id").agg(F.sum("dollar_exposure").alias("total")), "account_id", "total", n)
    action = F.concat(F.lit("Prioritize reconciliation review for account "), F.col("account_id").cast("string"))
    return _flags(top, _flag("HIGH_BREAK_CONCENTRATION_ACCOUNT", "HIGH", "TOP_N_ACCOUNT_EXPOSURE", action,
                             "reconciliation_breaks.csv", amount="total", threshold=n, rank="rank"))


def break_concentration_category(breaks: DataFrame, n: int = fixed.CONCENTRATION_TOP_N) -> DataFrame:
    rows = breaks.where("dollar_exposure is not null and break_category is not null")
    top = _top(rows.groupBy("break_category").agg(F.count("*").alias("total")), "break_category", "total", n)
    action = F.concat(F.lit("Review systemic cause of frequent '"), F.col("break_category"), F.lit("' breaks"))
    return _flags(top, _flag("HIGH_BREAK_CONCENTRATION_CATEGORY", "MEDIUM", "DOMINANT_BREAK_CATEGORY", action,
                             "reconciliation_breaks.csv", account=None, amount="total", threshold=n, rank="rank"))


def exception_concentration(log: DataFrame, n: int = fixed.CONCENTRATION_TOP_N) -> DataFrame:
    rows = log.where("severity = 'HIGH' and root_cause is not null")
    top = _top(rows.groupBy("root_cause").agg(F.count("*").alias("total")), "root_cause", "total", n)
    action = F.concat(F.lit("Perform root-cause review for '"), F.col("root_cause"),
                      F.lit("'; consider control enhancement"))
    return _flags(top, _flag("HIGH_EXCEPTION_CONCENTRATION", "HIGH", "RECURRING_HIGH_SEVERITY_ROOT_CAUSE", action,
                             "exception_log.csv", account=None, amount="total", threshold=n, rank="rank"))


def large_cash_transactions(cash: DataFrame, limit: float = fixed.LARGE_MOVEMENT) -> DataFrame | None:
    """Single transactions above the limit; ``None`` when no amount column is known."""
    amount = first_present(cash, fixed.CASH_AMOUNT_NAMES)
    if amount is None:
        return None
    day = first_present(cash, fixed.CASH_DATE_NAMES)
    size = as_number(cash, amount)
    large = cash.where(F.abs(size) > limit)
    return _flags(large, _flag(
        "LARGE_CASH_TRANSACTION", "HIGH", "TRANSACTION_EXCEEDS_THRESHOLD",
        "Verify supporting documentation for large cash inflow/outflow", "cash_transactions.csv",
        txn="transaction_id" if "transaction_id" in cash.columns else None,
        day=as_day(cash, day) if day else None, amount=size, threshold=limit))


def ledger_anomalies(ledger: DataFrame, workspace: Workspace, excess: float = fixed.EXCESS_CASH,
                     movement: float = fixed.LARGE_MOVEMENT) -> list[DataFrame]:
    """The balance rules on the internal ledger; empty when no balance column is known."""
    balance = first_present(ledger, fixed.LEDGER_BALANCE_NAMES)
    if balance is None:
        return []
    day = first_present(ledger, fixed.LEDGER_DATE_NAMES)
    rows = standard_balances(ledger, day, balance)
    out = [level_flags(rows, _LEDGER, excess)]
    if day:
        out.append(large_movements(rows, workspace, _LEDGER, movement))
    return out


def anomaly_flags(workspace: Workspace, custodian: DataFrame | None, breaks: DataFrame | None,
                  log: DataFrame | None, cash: DataFrame | None = None, ledger: DataFrame | None = None,
                  excess: float = fixed.EXCESS_CASH, movement: float = fixed.LARGE_MOVEMENT,
                  z_limit: float = fixed.Z_SCORE, outliers: DataFrame | None = None) -> DataFrame | None:
    """All rules on the inputs that are there, in rule order with consecutive ids.

    ``outliers`` are the custodian balances' ``account_outliers`` where they are known already.
    ``None`` when no input is there.
    """
    found: list[DataFrame] = []
    if custodian is not None:
        rows = standard_balances(custodian, "balance_date", "custodian_cash_balance")
        found += [level_flags(rows, excess=excess), large_movements(rows, workspace, limit=movement),
                  statistical_outliers(account_outliers(rows, workspace, z_limit) if outliers is None else outliers, z_limit)]
    if breaks is not None:
        found += [break_concentration_account(breaks), break_concentration_category(breaks)]
    if log is not None:
        found.append(exception_concentration(log))
    if cash is not None:
        large = large_cash_transactions(cash, movement)
        found += [large] if large is not None else []
    if ledger is not None:
        found += ledger_anomalies(ledger, workspace, excess, movement)
    if not found:
        return None
    rule = lookup(F.col("anomaly_type"), _RULE_ORDER, F.lit(None).cast("int"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    order = ["_rule", "_rank", "account_id", "transaction_date", "balance", "amount", "transaction_id"]
    numbered = ordered_id(out.withColumn("_rule", rule), order, "anomaly_id", workspace, start=1)
    return numbered.select("anomaly_id", *ANOMALY_FLAGS.fieldNames())


def anomaly_summary(found: DataFrame) -> DataFrame:
    """Flags by type and severity with a recommended action."""
    average = F.when(F.count("balance") > 0, F.sum("balance").cast("double") / F.count("balance"))
    return found.groupBy("anomaly_type", "severity").agg(
        F.count("anomaly_id").alias("record_count"), F.count_distinct("account_id").alias("unique_accounts"),
        F.round(F.coalesce(F.sum("amount"), F.lit(0)), 2).alias("total_amount"),
        F.round(average, 2).alias("avg_balance"),
    ).withColumn("recommended_action",
                 lookup(F.col("anomaly_type"), fixed.ANOMALY_ACTIONS, fixed.DEFAULT_ANOMALY_ACTION))


_SUMMARY = [("run_date", "string"), ("input_file", "string"), ("records_tested", "bigint"),
            ("checks_performed", "bigint"), ("failed_checks", "bigint"), ("anomaly_count", "bigint"),
            ("high_risk_count", "bigint"), ("pass_rate", "double"), ("notes", "string")]


def validation_summary(run_date: str, anomalies: DataFrame | None, vendor: DataFrame | None,
                       quality: DataFrame | None) -> DataFrame:
    """One row per suite. Anomalies are flags for review, so they neither fail nor have a rate."""
    spark = next(df for df in (anomalies, vendor, quality) if df is not None).sparkSession
    n, high = F.count("*"), F.count_if(F.col("severity") == "HIGH")
    zero = F.lit(0)

    def row(found, inputs, checks, failed, flagged, risk, rate, notes):
        values = [F.lit(run_date), F.lit(inputs), n, checks, failed, flagged, risk, rate, notes]
        return found.agg(*[v.cast(t).alias(c) for v, (c, t) in zip(values, _SUMMARY)])

    def failed_suite(name, inputs):
        return literal_frame(spark, [(run_date, inputs, 0, 0, 0, 0, 0, None, f"Module {name} failed to complete")],
                             _SUMMARY)

    shown = lambda c: F.format_number(c, 0)
    parts = []
    if anomalies is None:
        parts.append(failed_suite("anomaly_detection", fixed.ANOMALY_INPUTS))
    else:
        parts.append(row(anomalies, fixed.ANOMALY_INPUTS, F.lit(fixed.ANOMALY_CHECK_FAMILIES), zero, n, high,
                         F.lit(None), F.concat(shown(n), F.lit(" anomaly flags generated for review; "), shown(high),
                                               F.lit(" HIGH severity"))))
    if vendor is None:
        parts.append(failed_suite("vendor_file_validation", fixed.VENDOR_INPUTS))
    else:
        parts.append(row(vendor, fixed.VENDOR_INPUTS, F.lit(fixed.VENDOR_CHECK_FAMILIES), n, zero, high,
                         F.when(n > 0, 0.0).otherwise(100.0),
                         F.concat(n.cast("string"), F.lit(" validation issues; "), high.cast("string"),
                                  F.lit(" HIGH severity"))))
    if quality is None:
        parts.append(failed_suite("data_quality_checks", fixed.QUALITY_INPUTS))
    else:
        bad = F.col("check_status") == "FAIL"
        failed, risk = F.count_if(bad), F.count_if(bad & (F.col("severity") == "HIGH"))
        parts.append(row(quality, fixed.QUALITY_INPUTS, n, failed, zero, risk,
                         F.round(F.lit(100.0) * (n - failed) / F.greatest(n, F.lit(1)), 1),
                         F.concat(failed.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" checks failed; "),
                                  risk.cast("string"), F.lit(" HIGH severity failures"))))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
