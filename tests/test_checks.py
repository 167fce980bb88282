from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerloom.operators import checks, ledger, reports
from tests.conftest import rows_of

LOG = ("exception_id bigint;break_id bigint;business_date date;root_cause string;dollar_exposure decimal(19,4);severity string;"
       "status string;sla_status string;break_type string;aging_days int")


def log(frame):
    return frame(LOG, (0, 0, "2020-01-01", "A", 10, "LOW", "OPEN", "OVER_SLA", "X", 2), (1, 1, "2020-01-01", "A", 20, "CRITICAL", "RESOLVED", "WITHIN_SLA", "X", 5),
                 (2, None, "2020-01-02", "MISSING_VENDOR_FILE", 0, "HIGH", "RESOLVED", "WITHIN_SLA", "X", 11), (3, 3, "2020-01-03", None, None, None, "IN_REVIEW", "OVER_SLA", None, 10))


ADJ = "injection_id int;exception_type string;expected_detection_rule string;affected_date date;impact_amount decimal(19,4);impact_shares decimal(28,8)"


def test_unmapped_actions_count_missing_ones_too(frame):
    staged = frame("raw_action string", ("buy",), ("BUY ",), ("x",), ("x",), (None,))
    mapping = frame("raw_action string;standardized_category string", ("Buy", "Buy"), ("x", None))
    assert rows_of(checks.unmapped_actions(staged, mapping)) == [("x", 2), (None, 1)]


def test_orphans_count_rows_not_keys(frame):
    facts = frame("account_id bigint", (1,), (1,), (2,), (None,))
    master = frame("account_id bigint", (2,))
    got = checks.orphan_accounts(facts, facts.where("account_id = 2"), master).first()
    assert tuple(got) == (3, 0)


def test_coverage_joins_on_date_alone(frame):
    adjustments = frame(ADJ, (0, "Fee", "r", "2020-01-01", None, None), (1, "Late", "r", "2020-05-01", None, None))
    assert rows_of(checks.adjustment_coverage(adjustments, log(frame)), "exception_type", "detected_count", "status") == [
        ("Fee", 2, "DETECTED"), ("Late", 0, "MISSED")]


def test_control_rows_meet_their_adjustment_by_either_name(frame):
    adjustments = frame(ADJ, (5, "Missing Vendor File", "r", "2020-01-02", None, None), (6, "MISSING_VENDOR_FILE", "r", "2020-01-02", None, None),
                        (7, "Fee", "r", "2020-01-02", None, None), (8, "None", "r", "2020-01-02", None, None))
    breaks = frame("break_id bigint;injection_id int;dollar_exposure decimal(19,4)", (0, 7, 10), (1, 7, 20), (3, None, 1))
    got = checks.injection_to_break(adjustments, breaks, log(frame))
    assert rows_of(got, "injection_id", "detected_break_count", "cumulative_detected_exposure", "detection_status") == [
        (5, 1, D("0E-8"), "DETECTED"), (6, 1, D("0E-8"), "DETECTED"), (7, 2, D("30.00000000"), "DETECTED"), (8, 0, D("0E-8"), "NOT DETECTED")]


def test_share_breaks_count_without_exposure(frame):
    adjustments = frame(ADJ, (1, "a", "r", "2020-01-01", None, None), (2, "b", "r", "2020-01-01", None, None))
    cash = frame("injection_id int;cash_variance decimal(19,4);break_type string", (1, -5, "CASH_BALANCE_BREAK"), (1, 9, "MATCHED"))
    shares = frame("injection_id int;break_type string", (1, "SHARE_QUANTITY_BREAK"))
    got = checks.injection_validation(adjustments, cash, shares)
    assert rows_of(got, "injection_id", "detected_break_count", "cumulative_detected_exposure", "detection_status") == [
        (1, 2, D("5.00000000"), "DETECTED"), (2, 0, D("0E-8"), "NOT_DETECTED")]


def test_exposure_prefers_amounts_over_shares(frame):
    adjustments = frame(ADJ, (0, "a", "r", "2020-01-01", "-2.5", None), (1, "b", "r", "2020-01-01", None, 10))
    breaks = frame("dollar_exposure decimal(19,4)", (4,))
    totals = dict(rows_of(reports.exposure_summary(adjustments, breaks, log(frame)), "exposure_metric", "total_value"))
    assert {k: float(v) for k, v in totals.items()} == {
        "Source-level injected exposure": 12.5, "Daily detected exposure": 4.0, "Cumulative detected exposure": 30.0, "Current open exposure": 10.0}


def test_aging_buckets_and_pivot(frame):
    assert rows_of(reports.aging_buckets(log(frame)), "aging_bucket", "exception_count") == [
        ("0-2 days", 1), ("10+ days", 1), ("3-5 days", 1), ("6-10 days", 1)]
    assert rows_of(reports.cause_status_pivot(log(frame))) == [
        ("A", 1, 0, 0, 1), ("MISSING_VENDOR_FILE", 0, 0, 0, 1), (None, 0, 1, 0, 0)]


def test_null_fields(frame):
    assert tuple(checks.null_critical_fields(log(frame)).first()) == (1, 1, 1, 1)


MAPPED = "raw_action string;cash_impact_sign int"
STAGED = "raw_action string;transaction_date date"


def test_mapped_rows_count_per_action(frame):
    staged = frame(STAGED, ("buy ", "2020-01-05"), ("BUY", "2020-01-02"), ("fee", "2020-01-01"), ("x", "2019-01-01"), (None, "2018-01-01"))
    mapping = frame(MAPPED, ("Buy", -1), ("fee", 0), ("x", None))
    got = checks.mapped_rows(staged, mapping, "cash_impact_sign").first()
    assert (got["rows"], str(got.first_day), str(got.last_day)) == (2, "2020-01-02", "2020-01-05")
    none = checks.mapped_rows(staged.where("false"), mapping, "cash_impact_sign").first()
    assert (none["rows"], none.first_day) == (0, None)


def test_days_held_equal_the_rows_of_positions(frame):
    trades = frame("account_id bigint;ticker string;transaction_date date;security_impact decimal(28,8)",
                   (1, "A", "2020-01-01", 5), (1, "A", "2020-01-04", -5), (1, "A", "2020-01-09", 2), (1, "A", "2020-01-09", -2),
                   (2, "A", "2020-01-08", 1), (2, None, "2020-01-08", 1), (3, "B", "2020-01-10", -4))
    want = ledger.positions(trades).count()
    got = checks.days_held(ledger.daily_net_shares(trades), F.lit("2020-01-10").cast("date")).first()["rows"]
    assert got == want == 3 + 1 + 3 + 1


def test_unequal_keys_are_the_breaks_of_two_books(frame):
    ours = frame("account_id bigint;day date;cash decimal(19,4)", (1, "2020-01-01", 5), (1, "2020-01-02", 5), (2, "2020-01-01", 1), (3, "2020-01-01", 0))
    theirs = frame("account_id bigint;on_day date;amount decimal(19,4)", (1, "2020-01-01", "5.01"), (1, "2020-01-02", "5.02"), (4, "2020-01-01", 0))
    assert checks.unequal_keys(ours, theirs, "0.01").first()["rows"] == 4


def test_logged_rows_follow_breaks_matches_and_control_faults(frame):
    breaks = frame("account_id bigint;business_date date;variance decimal(28,8)", (1, "2020-01-01", 5), (1, "2020-01-01", 5), (2, "2020-01-01", 7), (3, None, None))
    matches = frame("account_id bigint;business_date date;cash_variance decimal(19,4)", (1, "2020-01-01", 5), (1, "2020-01-01", 5), (1, "2020-01-01", 5), (2, "2020-01-02", 7))
    adjustments = frame("exception_type string", ("Missing Vendor File",), ("Fee Mismatch",), (None,))
    assert checks.logged_rows(breaks, matches, adjustments).first()["rows"] == 6 + 1 + 1 + 1


def test_a_lost_or_added_row_fails_its_layer_and_unset_ones_say_so(frame):
    tables = {"a": frame("x int", (1,), (2,)), "b": frame("x int", (1,)), "c": frame("x int")}
    expected = frame("object_name string;expected_count bigint", ("a", 2), ("b", 2))
    assert rows_of(checks.layer_counts(tables, expected)) == [("a", 2, 2, "PASS"), ("b", 1, 2, "FAIL"), ("c", 0, None, "NOT_SET")]
