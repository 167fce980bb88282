import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import exceptions, recon
from tests.conftest import rows_of

INT = "account_id bigint;ledger_date date;cash_balance decimal(19,4)"
CUS = "account_id bigint;balance_date date;custodian_cash_balance decimal(19,4);injection_id int"


def full_outer(internal, custodian):
    out, used = [], set()
    for a, d, v, i in custodian:
        hits = [n for n, r in enumerate(internal) if None not in (a, d) and r[:2] == (a, d)]
        used |= set(hits)
        out += [(a, d, internal[n][2], v, i) for n in hits] or [(a, d, None, v, i)]
    return out + [(a, d, v, None, None) for n, (a, d, v) in enumerate(internal) if n not in used]


def test_comparison_equals_a_nested_loop_with_copies_and_empty_keys(frame):
    rng = random.Random(1)
    day = lambda: rng.choice([None] + [date(2020, 1, 1 + n) for n in range(5)])
    account = lambda: rng.choice([None, 1, 2, 3])
    internal = [(account(), day(), D(rng.randint(0, 3))) for _ in range(30)]
    custodian = [(account(), day(), D(rng.randint(0, 3)), rng.choice([None, 1])) for _ in range(40)]
    custodian += [(1, date(2020, 1, 1), D(2), None)] * 20
    got = recon.cash_recon(frame(INT, *internal), frame(CUS, *custodian))
    assert rows_of(got, "account_id", "business_date", "internal_cash", "custodian_cash", "injection_id") == sorted(
        [(a, d, None if x is None else x.quantize(D("1.0000")), None if y is None else y.quantize(D("1.0000")), i)
         for a, d, x, y, i in full_outer(internal, custodian)], key=repr)


def test_break_types_at_the_tolerance(frame):
    d = "2020-01-01"
    got = recon.cash_recon(
        frame(INT, (1, d, "1.01"), (2, d, "1.0101"), (3, d, "1"), (5, d, "1")),
        frame(CUS, (1, d, "1", None), (2, d, "1", None), (4, d, "1", 7), (5, d, "1", None)))
    assert dict(rows_of(got, "account_id", "break_type")) == {
        1: "MATCHED", 2: "CASH_BALANCE_BREAK", 3: "MISSING_IN_CUSTODIAN", 4: "MISSING_IN_INTERNAL", 5: "MATCHED"}


def test_books_without_fault_ids_compare_too(frame):
    d = "2020-01-01"
    got = recon.cash_recon(frame(INT, (1, d, 1)), frame(CUS, (1, d, 2, None)).drop("injection_id"))
    assert rows_of(got, "cash_variance", "injection_id") == [(D("-1.0000"), None)]


def test_a_hot_key_is_split_and_no_row_is_lost(spark, workspace):
    """A third of the custodian rows share one key; the join must split that key's partition."""
    internal = spark.range(3000).select(F.col("id").alias("account_id"), F.lit("2020-01-01").cast("date").alias("ledger_date"),
                                        F.lit(5).cast("decimal(19,4)").alias("cash_balance"))
    custodian = spark.range(0, 90_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000).alias("account_id"),
        F.lit("2020-01-01").cast("date").alias("balance_date"), F.col("id").cast("decimal(19,4)").alias("custodian_cash_balance"),
        F.lit(None).cast("int").alias("injection_id"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = recon.cash_recon(workspace.write(internal, "internal"), workspace.write(custodian, "custodian"))
        totals = df.agg(F.count("*").alias("n"), F.sum("custodian_cash").alias("s")).collect()
        alone = df.where("custodian_cash is null").count()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    one_sided = 3000 - len({7 if i % 3 == 0 else i % 3000 for i in range(90_000)})
    assert totals[0].n == 90_000 + one_sided and totals[0].s == sum(range(90_000)) and alone == one_sided
    assert "skew=true" in plan and "ReusedExchange" in plan


def brute_matches(breaks, cash, days=3):
    out = set()
    for a, d, v in breaks:
        for t, b, td, x in cash:
            if a == b and td == d and v == x:
                out.add((a, d, v, t, "MISSING_IN_CUSTODIAN"))
            elif a == b and td == d and v == -x:
                out.add((a, d, v, t, "DUPLICATE_TRANSACTION"))
            if a == b and d - timedelta(days) <= td < d and v == -x:
                out.add((a, d, v, t, "TIMING_DIFFERENCE"))
    return sorted(out, key=repr)


def test_matches_equal_all_pairs(frame):
    rng = random.Random(2)
    day = lambda: date(2020, 1, 1) + timedelta(rng.randint(0, 9))
    amount = lambda: D(rng.choice([-2, -1, 1, 2])).quantize(D("1.0000"))
    breaks = [(rng.randint(1, 2), day(), amount()) for _ in range(30)]
    cash = [(n, rng.randint(1, 2), day(), amount()) for n in range(40)]
    comparison = frame("account_id bigint;business_date date;cash_variance decimal(19,4);break_type string",
                       *[(*b, "CASH_BALANCE_BREAK") for b in breaks * 2], (1, "2020-01-01", 1, "MATCHED"))
    transactions = frame("transaction_id bigint;account_id bigint;transaction_date date;cash_impact decimal(19,4)", *cash)
    assert rows_of(recon.transaction_match(comparison, transactions)) == brute_matches(breaks, cash)
    same = recon.same_day_match(comparison, transactions)
    late = recon.timing_match(comparison, transactions)
    assert rows_of(same.unionByName(late)) == brute_matches(breaks, cash)


BREAKS = ("break_id bigint;account_id bigint;business_date date;ticker string;break_category string;internal_value decimal(28,8);"
          "custodian_value decimal(28,8);variance decimal(28,8);dollar_exposure decimal(19,4);injection_id int")
MATCHES = "account_id bigint;business_date date;cash_variance decimal(19,4);transaction_id bigint;inferred_root_cause string"


def one_break(n, category="CASH_BALANCE_BREAK", variance="1", exposure=None, day="2020-01-01", account=1, ticker=None):
    return (n, account, day, ticker, category, None, None, variance, exposure or str(abs(D(variance))), None)


@pytest.mark.parametrize("exposure,label", [("5000.01", "CRITICAL"), ("5000", "HIGH"), ("500.01", "HIGH"), ("500", "MEDIUM"),
                                            ("50.01", "MEDIUM"), ("50", "LOW"), ("0", "LOW")])
def test_severity_is_strict(frame, exposure, label):
    df = frame("e decimal(19,4)", (exposure,))
    assert df.select(exceptions.severity(F.col("e"))).first()[0] == label


@pytest.mark.parametrize("variance,cause", [
    ("-4.99", "FEE_MISMATCH"), ("5", "DIVIDEND_MISMATCH"), ("20", "CONTROLLED_CASH_EXCEPTION_CARRYFORWARD"),
    ("240", "DUPLICATE_CUSTODIAN_CASH_RECORD"), ("-260", "DUPLICATE_CUSTODIAN_CASH_RECORD"),
    ("260.01", "CONTROLLED_CASH_EXCEPTION_CARRYFORWARD"), ("490", "SETTLEMENT_TIMING_DIFFERENCE"),
    ("510", "SETTLEMENT_TIMING_DIFFERENCE"), ("489.99", "CONTROLLED_CASH_EXCEPTION_CARRYFORWARD")])
def test_cash_causes_by_size(frame, variance, cause):
    df = frame("c string;v decimal(28,8)", ("CASH_BALANCE_BREAK", variance))
    assert df.select(exceptions.rule_cause(F.col("c"), F.col("v"))).first()[0] == cause


def test_status_cycle_and_sla(frame):
    df = exceptions.with_status(frame(BREAKS, *[one_break(n, day="2020-01-0%d" % (1 + n % 3)) for n in range(10)]), "2020-01-04")
    got = {r.break_id: (r.status, r.sla_status, r.aging_days) for r in df.collect()}
    assert [got[n][0] for n in range(10)] == ["OPEN"] * 2 + ["IN_REVIEW"] * 2 + ["PENDING_VENDOR"] + ["RESOLVED"] * 5
    assert got[0] == ("OPEN", "OVER_SLA", 3) and got[1] == ("OPEN", "WITHIN_SLA", 2) and got[6][1] == "WITHIN_SLA"


def test_two_matches_double_a_break_unless_deduped(frame):
    breaks = frame(BREAKS, one_break(0, variance="7"), one_break(1, variance="3"))
    matches = frame(MATCHES, (1, "2020-01-01", 7, 1, "TIMING_DIFFERENCE"), (1, "2020-01-01", 7, 2, "MISSING_IN_CUSTODIAN"))
    assert rows_of(exceptions.exception_log(breaks, matches), "break_id", "root_cause") == [
        (0, "MISSING_IN_CUSTODIAN"), (0, "TIMING_DIFFERENCE"), (1, "FEE_MISMATCH")]
    assert rows_of(exceptions.exception_log(breaks, matches, dedupe=True), "break_id", "root_cause") == [
        (0, "MISSING_IN_CUSTODIAN"), (1, "FEE_MISMATCH")]


def test_whole_log_reclassifies_adds_evidence_and_control_rows(frame, workspace):
    breaks = frame(BREAKS, one_break(0), one_break(1, "SHARE_QUANTITY_BREAK", ticker="AAPL"), one_break(2, "SHARE_QUANTITY_BREAK", ticker="X"),
                   one_break(3, "MISSING_IN_CUSTODIAN", day="2020-02-02"))
    adjustments = frame("exception_type string;affected_date date;account_id bigint",
                        ("Missing Vendor File", "2020-02-02", None),  # the log has this cause on this day
                        ("Missing Vendor File", "2020-02-03", None), ("Wrong Account Posting", "2020-02-02", 7), ("Fee Mismatch", "2020-02-02", 1))
    log = exceptions.complete_log(breaks, frame(MATCHES, (9, "2020-01-01", 1, 1, "x")), adjustments, workspace)
    assert rows_of(log, "exception_id", "break_id", "root_cause", "account_id") == [
        (0, 0, "FEE_MISMATCH", 1), (1, 1, "CONTROLLED_AAPL_POSITION_OVERSTATEMENT", 1), (2, 2, "CORPORATE_ACTION_OR_TRADE_BREAK", 1),
        (3, 3, "MISSING_VENDOR_FILE", 1), (4, None, "MISSING_VENDOR_FILE", 1), (5, None, "WRONG_ACCOUNT_POSTING", 7)]
    assert log.where("evidence_file is null or trim(evidence_file) = ''").count() == 0
