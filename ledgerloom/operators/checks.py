"""Pipeline checks: counts, tie-outs, orphans and coverage of known faults."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import MONEY, SHARES, match_key, null_count
from ledgerloom.operators.fingerprints import agreement


def _pass(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def _count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).drop("id")


def row_count_tieout(raw: DataFrame, staged: DataFrame) -> DataFrame:
    counts = raw.agg(F.count("*").alias("raw_count")).withColumn("staging_count", _count(staged))
    return counts.select(F.lit("Row Count Validation").alias("check_name"), "raw_count", "staging_count",
                         _pass(F.col("raw_count") == F.col("staging_count")).alias("status"))


def layer_counts(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Row count of every table next to the number expected; NOT_SET where there is none.

    ``expected`` holds ``object_name`` and ``expected_count``, a row for each table at most (see ``expected_counts``).
    """
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("object_name"), "row_count") for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, counts).join(F.broadcast(expected), "object_name", "left")
    same = _pass(F.col("row_count") == F.col("expected_count"))
    return out.select("object_name", "row_count", "expected_count", F.when(F.col("expected_count").isNull(), "NOT_SET").otherwise(same).alias("status"))


def mapped_rows(staged: DataFrame, mapping: DataFrame, sign: str) -> DataFrame:
    """How many of the rows the mapping books under ``sign``, and their first and last day, in one row.

    Rows are counted per action before they meet the mapping, so no row is joined.
    """
    booked = mapping.where(F.col(sign) != 0).groupBy(match_key(F.col("raw_action")).alias("_action")).agg(F.count("*").alias("_times"))
    actions = staged.groupBy(match_key(F.col("raw_action")).alias("_action")).agg(
        F.count("*").alias("_n"), F.min("transaction_date").alias("_first"), F.max("transaction_date").alias("_last"))
    return actions.join(booked, "_action").agg(
        F.coalesce(F.sum(F.col("_n") * F.col("_times")), F.lit(0)).alias("rows"), F.min("_first").alias("first_day"), F.max("_last").alias("last_day"))


def days_held(moves: DataFrame, last_day: Column) -> DataFrame:
    """Number of position rows that the daily movements lead to, by arithmetic on the days between them.

    A holding counts on every day up to the next movement, a day that ends at zero only itself.
    """
    key = Window.partitionBy("account_id", "ticker").orderBy("transaction_date")
    held = F.sum("daily_net_shares").over(key.rowsBetween(Window.unboundedPreceding, 0))
    until = F.coalesce(F.lead("transaction_date").over(key), F.date_add(last_day, 1))
    known = moves.where("account_id is not null and ticker is not null and transaction_date is not null")
    runs = known.select(held.alias("held"), F.date_diff(until, F.col("transaction_date")).alias("days"), "daily_net_shares")
    days = F.when(F.col("held") != 0, F.col("days")).when(F.col("daily_net_shares") != 0, 1).otherwise(0)
    return runs.agg(F.coalesce(F.sum(days), F.lit(0)).alias("rows"))


def unequal_keys(ours: DataFrame, theirs: DataFrame, tolerance: str) -> DataFrame:
    """How many keys one of two books lacks or shows with another value: both books stacked and folded by key.

    The last column of each book is its value, the others its key.
    """
    *keys, value = ours.columns
    signed = lambda df, side, sign: df.toDF(*keys, value).withColumns(
        {value: F.col(value).cast(SHARES) * sign, "_ours": F.lit(int(side)), "_theirs": F.lit(int(not side))})
    both = signed(ours, True, 1).unionByName(signed(theirs, False, -1)).groupBy(*keys).agg(
        F.sum(value).alias("_off"), F.sum("_ours").alias("_ours"), F.sum("_theirs").alias("_theirs"))
    differs = (F.col("_ours") == 0) | (F.col("_theirs") == 0) | (F.abs("_off") > F.lit(tolerance).cast(SHARES))
    return both.agg(F.count_if(differs).alias("rows"))


def logged_rows(breaks: DataFrame, matches: DataFrame, adjustments: DataFrame) -> DataFrame:
    """How many exceptions breaks lead to: one each, or one for each transaction that explains it, and one for each control fault."""
    keys = ["account_id", "business_date", "variance"]
    times = matches.select("account_id", "business_date", F.col("cash_variance").cast(SHARES).alias("variance")).groupBy(*keys).agg(F.count("*").alias("_times"))
    each = breaks.groupBy(*keys).agg(F.count("*").alias("_n")).join(times, keys, "left").select(F.col("_n") * F.coalesce("_times", F.lit(1)))
    controls = adjustments.where(F.col("exception_type").isin(*fixed.CONTROL_EXCEPTIONS)).select(F.lit(1).cast("bigint"))
    return each.union(controls).toDF("_n").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))


def expected_counts(one_row: DataFrame, staged_cash: DataFrame, staged_trades: DataFrame, mapping: DataFrame, accounts: DataFrame,
                    moves: DataFrame, lost_balances: DataFrame, added_balances: DataFrame, added_positions: DataFrame,
                    cash_books: tuple[DataFrame, DataFrame], share_books: tuple[DataFrame, DataFrame],
                    breaks: DataFrame, matches: DataFrame, adjustments: DataFrame) -> DataFrame:
    """How many rows each layer should have, told from what it is built from and not from the layer.

    Transactions are counted per action, ledger days are days times accounts, positions the days between movements;
    custodian books have the known faults' rows more or less (``lost_balances`` holds account and day); breaks are the
    keys on which the books differ, and exceptions follow from breaks, matches and control faults. Returns
    ``object_name`` and ``expected_count``, eight rows.
    """
    cash = mapped_rows(staged_cash.where("flag_invalid_date = 0 and flag_invalid_amount = 0"), mapping, "cash_impact_sign")
    trades = mapped_rows(staged_trades.where("flag_invalid_date = 0 and ticker is not null"), mapping, "security_impact_sign")
    number = lambda df: df.agg(F.count("*")).scalar()
    first, last = (cash.select(c).scalar() for c in ("first_day", "last_day"))
    days = F.coalesce(F.date_diff(last, first) + 1, F.lit(0))
    balances = number(accounts) * days
    lost = number(lost_balances.toDF("account_id", "_day").join(accounts.select("account_id"), "account_id", "left_semi").where(F.col("_day").between(first, last)))
    held = days_held(moves, trades.select("last_day").scalar()).scalar()
    expected = {
        "cash_transactions": cash.select("rows").scalar(), "security_transactions": trades.select("rows").scalar(),
        "internal_ledger_balances": balances, "custodian_balances": balances - lost + number(added_balances),
        "positions": held, "custodian_positions": held + number(added_positions),
        "reconciliation_breaks": unequal_keys(*cash_books, fixed.CASH_TOLERANCE).scalar() + unequal_keys(*share_books, fixed.SHARE_TOLERANCE).scalar(),
        "exception_log": logged_rows(breaks, matches, adjustments).scalar()}
    row = F.array(*[F.struct(F.lit(name).alias("object_name"), n.cast("bigint").alias("expected_count")) for name, n in expected.items()])
    return one_row.select(F.inline(row))


def rollforward_status(rollforward: DataFrame) -> DataFrame:
    failures = F.col("failure_count")
    return rollforward.agg(F.count("*").alias("failure_count")).select(
        F.lit("Ledger Roll-Forward").alias("validation_check"), _pass(failures == 0).alias("validation_status"),
        failures,
        F.when(failures == 0, "All balances equal prior balance plus movement")
        .otherwise("Balances differ from prior balance plus movement").alias("validation_notes"))


def duplicate_ids(df: DataFrame, column: str) -> DataFrame:
    return (df.groupBy(column).agg(F.count("*").alias("occurrences")).where("occurrences > 1"))


def duplicate_transaction_ids(cash: DataFrame, trades: DataFrame) -> DataFrame:
    one = lambda df, name: duplicate_ids(df, "transaction_id").select(
        F.lit(name).alias("table_name"), "transaction_id", F.col("occurrences").alias("duplicate_count"))
    return one(cash, "cash_transactions").unionByName(one(trades, "security_transactions"))


def failed_casts(staged: DataFrame) -> DataFrame:
    """Both failed-cast counts from one scan."""
    return staged.agg(F.count_if(F.col("flag_invalid_date") == 1).alias("failed_dates"),
                      F.count_if(F.col("flag_invalid_amount") == 1).alias("failed_amounts"))


def missing_required(staged: DataFrame) -> DataFrame:
    gone = F.col("account_id").isNull() | F.col("raw_action").isNull()
    return staged.agg(F.count_if(gone).alias("missing_fields_count"))


def missing_field_matrix(cash: DataFrame, trades: DataFrame) -> DataFrame:
    fields = ["transaction_id", "account_id", "transaction_date", "transaction_type"]
    one = lambda df, name: df.agg(*[null_count(F.col(c)).alias(f"missing_{c}") for c in fields]).select(
        F.lit(name).alias("table_name"), "*")
    return one(cash, "cash_transactions").unionByName(one(trades, "security_transactions"))


def unmapped_actions(staged: DataFrame, mapping: DataFrame) -> DataFrame:
    """Actions the mapping lacks, empty ones included, with their row counts.

    Rows are counted per action first, so only the few distinct actions meet the mapping.
    """
    counted = staged.groupBy("raw_action").agg(F.count("*").alias("occurrences"))
    known = mapping.where("standardized_category is not null").select(match_key(F.col("raw_action")).alias("_action"))
    return (counted.withColumn("_action", match_key(F.col("raw_action")))
            .join(known, "_action", "left_anti").select("raw_action", "occurrences"))


def _orphan_rows(facts: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Facts whose key the master lacks, counted per key before the join."""
    return facts.groupBy(key).agg(F.count("*").alias("_rows")).join(master.select(key), key, "left_anti")


def _orphan_count(facts: DataFrame, master: DataFrame, key: str) -> Column:
    return _orphan_rows(facts, master, key).agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()


def broken_security_joins(trades: DataFrame, securities: DataFrame) -> DataFrame:
    return _orphan_rows(trades, securities, "ticker").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("broken_joins_count"))


def orphan_accounts(cash: DataFrame, trades: DataFrame, accounts: DataFrame) -> DataFrame:
    return _one_row(cash.sparkSession).select(
        _orphan_count(cash, accounts, "account_id").alias("orphan_cash_transactions"),
        _orphan_count(trades, accounts, "account_id").alias("orphan_security_transactions"))


def negative_positions(positions: DataFrame) -> DataFrame:
    return positions.where("share_quantity < 0")


def open_over_sla(log: DataFrame) -> DataFrame:
    return log.where("status <> 'RESOLVED' and sla_status = 'OVER_SLA'").orderBy(F.desc("aging_days"), "exception_id")


def missing_dates(transactions: DataFrame, column: str = "transaction_date") -> DataFrame:
    return transactions.agg(null_count(F.col(column)).alias("missing_transaction_date_count"))


def recon_coverage(ledger: DataFrame, custodian: DataFrame, positions: DataFrame,
                   custodian_positions: DataFrame) -> DataFrame:
    one = lambda name, a, b: a.agg(F.count("*").alias("internal_count")).select(
        F.lit(name).alias("check_name"), "internal_count", _count(b).alias("custodian_count"))
    return one("Cash Record Count", ledger, custodian).unionByName(
        one("Position Record Count", positions, custodian_positions))


def adjustment_counts(adjustments: DataFrame, balances: DataFrame, positions: DataFrame,
                      planned: int = fixed.PLANNED_INJECTIONS) -> DataFrame:
    touched = lambda df: df.agg(F.count_if(F.col("simulation_flag") == "INJECTED")).scalar()
    return adjustments.agg(F.count("*").alias("actual_injections")).select(
        "actual_injections", F.lit(planned).alias("planned_injections"),
        _pass(F.col("actual_injections") == planned).alias("status"),
        touched(balances).alias("modified_cash_records"), touched(positions).alias("modified_position_records"))


def missing_files(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count_if(F.col("receipt_status") == "MISSING").alias("missing_count"))


def orphan_adjustments(balances: DataFrame) -> DataFrame:
    stray = (F.col("simulation_flag") == "INJECTED") & F.col("injection_id").isNull()
    return balances.agg(F.count_if(stray).alias("orphan_count"))


def adjustment_coverage(adjustments: DataFrame, log: DataFrame) -> DataFrame:
    """Adjustments with the number of exceptions on their date, whatever the cause.

    Exceptions are counted per date first, so a busy date is one row in the join.
    """
    per_day = log.groupBy("business_date").agg(F.count("exception_id").alias("_found"))
    found = F.coalesce(F.sum("_found"), F.lit(0))
    return (
        adjustments.join(per_day, F.col("affected_date") == F.col("business_date"), "left")
        .groupBy("exception_type", "affected_date")
        .agg(found.alias("detected_count"))
        .withColumn("status", F.when(F.col("detected_count") > 0, "DETECTED").otherwise("MISSED"))
        .orderBy("affected_date", "exception_type")
    )


def _detection(adjustments: DataFrame, found: DataFrame, missed: str) -> DataFrame:
    count = F.coalesce("_count", F.lit(0))
    return adjustments.join(found, "injection_id", "left").select(
        "injection_id", "exception_type", "expected_detection_rule", count.alias("detected_break_count"),
        F.coalesce("_exposure", F.lit(0).cast(SHARES)).cast("decimal(38,8)").alias("cumulative_detected_exposure"),
        F.when(count > 0, "DETECTED").otherwise(missed).alias("detection_status"))


def injection_validation(adjustments: DataFrame, cash_comparison: DataFrame,
                         position_comparison: DataFrame) -> DataFrame:
    """Breaks per adjustment from both comparisons; share breaks count but carry no exposure."""
    tagged = "injection_id is not null and break_type <> 'MATCHED'"
    zero = F.lit(0).cast(MONEY)
    rows = cash_comparison.where(tagged).select(
        "injection_id", F.abs(F.coalesce("cash_variance", zero)).alias("_size")
    ).unionByName(position_comparison.where(tagged).select("injection_id", zero.alias("_size")))
    found = rows.groupBy("injection_id").agg(F.count("*").alias("_count"), F.sum("_size").alias("_exposure"))
    return _detection(adjustments, found, "NOT_DETECTED")


def injection_to_break(adjustments: DataFrame, breaks: DataFrame, log: DataFrame) -> DataFrame:
    """Breaks plus control-level exceptions per adjustment, shares priced.

    A control-level exception belongs to an adjustment when its cause equals the adjustment type or
    is the code of that type: two alternatives, written out as two equality keys per cause. Both
    sides are summed before they meet.
    """
    from_breaks = breaks.groupBy("injection_id").agg(
        F.count("break_id").alias("_count"), F.sum("dollar_exposure").cast(SHARES).alias("_exposure"))
    code = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind, (cause, _) in fixed.CONTROL_EXCEPTIONS.items():
        code = code.when(F.col("root_cause") == cause, kind.lower())
    per_cause = log.where("break_id is null").groupBy("root_cause").agg(
        F.count("exception_id").alias("_count"), F.sum("dollar_exposure").cast(SHARES).alias("_exposure"))
    keys = F.array_compact(F.array_distinct(F.array(F.lower("root_cause"), code)))
    from_controls = (
        adjustments.select("injection_id", F.lower("exception_type").alias("_kind"))
        .join(per_cause.select("_count", "_exposure", F.explode(keys).alias("_kind")), "_kind")
        .select("injection_id", "_count", "_exposure")
    )
    found = from_breaks.unionByName(from_controls).groupBy("injection_id").agg(
        F.sum("_count").alias("_count"), F.sum("_exposure").alias("_exposure"))
    return _detection(adjustments, found, "NOT DETECTED").orderBy("injection_id")


def null_critical_fields(log: DataFrame) -> DataFrame:
    fields = {"null_type": "break_type", "null_cause": "root_cause", "null_severity": "severity",
              "null_exposure": "dollar_exposure"}
    return log.agg(*[null_count(F.col(c)).alias(name) for name, c in fields.items()])


def exception_completeness(log: DataFrame) -> DataFrame:
    fields = ["break_id", "account_id", "break_type", "severity", "root_cause", "owner", "status", "detected_date",
              "due_date", "aging_days", "sla_status"]
    evidence = F.col("evidence_file").isNull() | (F.trim("evidence_file") == "")
    return log.agg(F.count("*").alias("total_exceptions"),
                   *[null_count(F.col(c)).alias(f"missing_{c}") for c in fields],
                   F.count_if(evidence).alias("missing_evidence_file"))


# Keys by which the rows of a published table are told apart.
PUBLISHED_KEYS = {
    "cash": ["transaction_id"], "trades": ["transaction_id"], "ledger": ["account_id", "ledger_date"],
    "custodian": ["account_id", "balance_date"], "breaks": ["break_id"], "log": ["exception_id"],
}


def tie_outs(source: dict[str, DataFrame], published: dict[str, DataFrame], rollforward: DataFrame,
             validation: DataFrame, planned: int = fixed.PLANNED_INJECTIONS) -> DataFrame:
    """Fourteen control tie-outs of the published tables against their sources.

    Both maps hold the tables of ``PUBLISHED_KEYS``. The row checks show both row counts and pass when
    the fingerprints of all key ranges agree as well, so a row that was altered, or lost and replaced, fails
    them; ``fingerprints.differences`` then tells which. Each pair of tables is read once for that.
    """
    number = lambda c: c.cast("double")

    def amounts(tables: dict[str, DataFrame]) -> dict[str, Column]:
        log = tables["log"].agg(F.struct(
            F.sum("dollar_exposure").alias("exposure"),
            F.count_if(F.col("evidence_file").isNull() | (F.trim("evidence_file") == "")).alias("no_evidence"),
        ).alias("f")).scalar()
        breaks = tables["breaks"].agg(F.struct(
            F.count_if(F.col("break_category") == "CASH_BALANCE_BREAK").alias("cash"),
            F.count_if(F.col("break_category") == "SHARE_QUANTITY_BREAK").alias("shares"),
        ).alias("f")).scalar()
        return {"exposure": number(F.round(log.getField("exposure"), 2)), "no_evidence": number(log.getField("no_evidence")),
                "cash_breaks": number(breaks.getField("cash")), "share_breaks": number(breaks.getField("shares"))}

    def rows(name: str) -> tuple[Column, Column, Column]:
        found = agreement(source[name], published[name], PUBLISHED_KEYS[name])
        one = found.select(F.struct("source_rows", "copy_rows", "differing_ranges").alias("f")).scalar()
        return number(one.getField("source_rows")), number(one.getField("copy_rows")), one.getField("differing_ranges") == 0

    want, got = amounts(source), amounts(published)
    found = validation.agg(F.struct(
        F.count("*").alias("tested"), F.count_if(F.col("detection_status") == "DETECTED").alias("detected"),
    ).alias("f")).scalar()
    tested, detected = number(found.getField("tested")), number(found.getField("detected"))
    lit = lambda n: F.lit(float(n))
    same = lambda name, e, a: (name, e, a, e.eqNullSafe(a))
    at_least = lambda name, e, a: (name, e, a, a >= e)
    checks = [
        ("Cash Transaction Rows", *rows("cash")),
        ("Security Transaction Rows", *rows("trades")),
        ("Internal Ledger Rows", *rows("ledger")),
        ("Custodian Balance Rows", *rows("custodian")),
        ("Reconciliation Break Rows", *rows("breaks")),
        ("Exception Log Rows", *rows("log")),
        same("Ledger Roll-Forward Failures", lit(0), number(_count(rollforward))),
        at_least("Injected Exceptions Tested", lit(planned), tested),
        at_least("Injected Exceptions Detected", lit(planned), detected),
        same("Injection Detection Rate", lit(1), F.round(detected / F.greatest(tested, F.lit(1.0)), 4)),
        same("Missing Evidence Count", lit(0), got["no_evidence"]),
        same("Total Dollar Exposure", want["exposure"], got["exposure"]),
        same("Cash Break Count", want["cash_breaks"], got["cash_breaks"]),
        same("Share Break Count", want["share_breaks"], got["share_breaks"]),
    ]
    structs = [F.struct(F.lit(i).alias("check_no"), F.lit(name).alias("check_name"), e.alias("expected"),
                        a.alias("actual"), _pass(ok).alias("status")) for i, (name, e, a, ok) in enumerate(checks, 1)]
    return _one_row(rollforward.sparkSession).select(F.inline(F.array(*structs)))
