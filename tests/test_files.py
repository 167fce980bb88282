import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerloom.operators import files
from tests.conftest import rows_of

ADJ = "injection_id int;account_id bigint;effective_date date;delta decimal(28,8);carry_forward boolean"


def test_overlays_equal_a_loop_and_never_multiply_rows(frame, monkeypatch):
    rng = random.Random(3)
    start = date(2020, 1, 1)
    adjustments = [(i, rng.randint(1, 3), start + timedelta(rng.randint(0, 20)), D(rng.randint(1, 9)), rng.random() < 0.5)
                   for i in range(12)]
    records = [(a, start + timedelta(d), D(100)) for a in range(1, 5) for d in range(25)] * 2
    df = frame("account_id bigint;balance_date date;value decimal(19,4)", *records)
    want = []
    for account, day, value in records:
        active = [x for x in adjustments if x[1] == account and (x[2] == day or (x[4] and x[2] < day))]
        want.append((account, day, value + sum((x[3] for x in active), D(0)),
                     max((x[0] for x in active), default=None), "INJECTED" if active else "CLEAN"))
    columns = ["account_id", "balance_date", "value", "injection_id", "simulation_flag"]
    for limit in (200_000, 0):  # broadcast, then the way beyond the size bound
        monkeypatch.setattr(files, "small_side", lambda d, limit=limit: __import__(
            "ledgerloom.functions.sizing", fromlist=["x"]).small_side(d, limit))
        got = files.apply_adjustments(df, frame(ADJ, *adjustments), ["account_id"], "balance_date", "value")
        assert rows_of(got, *columns) == sorted(want, key=repr)


def test_many_overlays_of_one_account_are_cut_at_months(spark, frame, monkeypatch):
    """100,000 overlays on one account, and open ones, beyond the broadcast bound."""
    monkeypatch.setattr(files, "small_side", lambda d: d)
    n, days = 100_000, 1500
    adjustments = spark.range(n).select(
        F.col("id").cast("int").alias("injection_id"), F.when(F.col("id") < n - 20, 1).otherwise(F.col("id") - n + 22).cast("bigint").alias("account_id"),
        F.date_add(F.lit("2019-11-20").cast("date"), (F.col("id") * 7919 % days).cast("int")).alias("effective_date"),
        F.lit("0.5").cast("decimal(28,8)").alias("delta"), (F.col("id") % 1000 == 0).alias("carry_forward"))
    records = spark.range(days + 400).select(
        F.explode(F.array([F.lit(k).cast("bigint") for k in (1, 3, 50)])).alias("account_id"),
        F.date_add(F.lit("2019-11-01").cast("date"), F.col("id").cast("int")).alias("balance_date"), F.lit(100).cast("decimal(19,4)").alias("value"))
    got = files.apply_adjustments(records, adjustments, ["account_id"], "balance_date", "value")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "month" in plan
    want = defaultdict(lambda: [D(0), None])
    listed = adjustments.collect()
    carried = [a for a in listed if a.carry_forward]
    for a in listed:
        if not a.carry_forward:
            cell = want[a.account_id, a.effective_date]
            cell[0], cell[1] = cell[0] + a.delta, a.injection_id if cell[1] is None else max(cell[1], a.injection_id)
    rows = got.collect()
    assert len(rows) == 3 * (days + 400)
    for r in rows:
        delta, last = want[r.account_id, r.balance_date] if (r.account_id, r.balance_date) in want else (D(0), None)
        lasting = [a for a in carried if a.account_id == r.account_id and a.effective_date <= r.balance_date]
        last = max([a.injection_id for a in lasting] + ([] if last is None else [last]), default=None)
        assert (r.value, r.injection_id) == (100 + delta + sum(a.delta for a in lasting), last)
    pieces = files.monthly_segments(files.adjustment_segments(adjustments, ["account_id"]), F.lit("2024-12-31").cast("date"))
    assert pieces.groupBy("account_id", "month").count().agg(F.max("count")).first()[0] <= 32


def test_overlays_meet_no_records_and_days_outside(frame):
    none = frame("account_id bigint;balance_date date;value decimal(19,4)")
    one = frame(ADJ, (1, 1, "2020-01-31", 5, True))
    assert files.apply_adjustments(none, one, ["account_id"], "balance_date", "value").count() == 0
    early = frame("account_id bigint;balance_date date;value decimal(19,4)", (1, "2019-12-31", 1), (1, None, 1), (None, "2020-02-01", 1))
    assert rows_of(files.apply_adjustments(early, one, ["account_id"], "balance_date", "value"), "value", "injection_id") == [(D("1.0000"), None)] * 3


def test_manifest_link_totals_and_tieout(frame):
    balances = frame("account_id bigint;ledger_date date;value decimal(19,4)",
                     (1, "2020-01-01", 5), (2, "2020-01-01", 6), (1, "2020-01-02", 7))
    positions = frame("account_id bigint;position_date date", (1, "2020-01-02"))
    manifest = files.file_manifest(balances, positions)
    assert rows_of(manifest, "source_file_id", "file_name") == [
        (0, "CUST_BAL_20200101.csv"), (1, "CUST_BAL_20200102.csv"), (2, "CUST_POS_20200102.csv")]
    assert str(manifest.first().received_timestamp) == "2020-01-01 06:00:00"
    linked = files.file_link(balances, manifest, "ledger_date", "CUST_BAL_")
    assert rows_of(linked, "account_id", "source_file_id") == [(1, 0), (1, 1), (2, 0)]
    totals = files.file_control_totals(linked, manifest, "value", "CUST_BAL_")
    assert rows_of(totals, "source_file_id", "record_count", "control_total") == [
        (0, 2, D("11.00000000")), (1, 1, D("7.00000000")), (2, None, None)]
    assert files.control_total_tieout(linked, totals, "value", "CUST_BAL_").count() == 0
    short = linked.where("account_id <> 2")
    assert rows_of(files.control_total_tieout(short, totals, "value", "CUST_BAL_"), "source_file_id", "actual_count",
                   "total_variance") == [(0, 1, D("6.00000000"))]
    gone = files.mark_missing_file(manifest, "2020-01-02", "CUST_POS_")
    assert rows_of(gone.where("receipt_status = 'MISSING'"), "source_file_id", "validation_status", "received_timestamp") == [
        (2, "FAILED", None)]


def test_file_prefix_is_text_not_a_pattern(frame):
    manifest = frame("source_file_id bigint;file_name string;expected_date date", (1, "CUSTXBALX1.csv", "2020-01-01"))
    records = frame("balance_date date", ("2020-01-01",))
    assert files.file_link(records, manifest, "balance_date", "CUST_BAL_").count() == 0


def test_misposting_moves_shares_to_a_stray_account(frame):
    df = frame("account_id bigint;ticker string;position_date date;custodian_share_quantity decimal(28,8);source_file_id bigint",
               (7, "M", "2020-01-01", 60, 1), (7, "M", "2020-01-02", 60, 2), (7, "M", "2020-01-03", 60, 3), (8, "M", "2020-01-02", 5, 2))
    got = files.apply_misposting(df, 9, "2020-01-02", "M", "50", 7, 999)
    assert rows_of(got, "account_id", "position_date", "custodian_share_quantity", "injection_id", "source_file_id") == sorted([
        (7, date(2020, 1, 1), D("60.00000000"), None, 1), (7, date(2020, 1, 2), D("10.00000000"), 9, 2),
        (7, date(2020, 1, 3), D("10.00000000"), 9, 3), (8, date(2020, 1, 2), D("5.00000000"), None, 2),
        (999, date(2020, 1, 2), D("50.00000000"), 9, 2)], key=repr)
