import random
from datetime import date, timedelta
from decimal import Decimal as D

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import anomaly
from ledgerloom.operators.ids import placed_rows
from ledgerloom.operators.ranks import group_quantiles
from tests.conftest import rows_of

BAL = "account_id bigint;day date;balance decimal(19,4)"


def test_levels(frame):
    df = frame(BAL, (1, "2020-01-01", "-0.01"), (1, "2020-01-02", "-5000"), (1, "2020-01-03", "-5000.01"), (2, "2020-01-01", 0),
               (2, "2020-01-02", 25000), (2, "2020-01-03", "25000.01"), (3, "2020-01-01", None))
    got = anomaly.level_flags(df)
    assert rows_of(got, "balance", "anomaly_type", "severity") == rows_of(
        anomaly.negative_balances(df).unionByName(anomaly.excess_cash(df)), "balance", "anomaly_type", "severity")
    assert rows_of(got, "balance", "severity") == sorted([(D("-0.01"), "MEDIUM"), (D("-5000.00"), "MEDIUM"), (D("-5000.01"), "HIGH"),
                                                          (D("25000.01"), "MEDIUM")], key=repr)


def test_changes_equal_a_sorted_loop_across_months_gaps_and_copies(frame, workspace):
    rng = random.Random(4)
    rows = [(rng.randint(1, 3), date(2020, 1, 20) + timedelta(rng.randint(0, 70)), D(rng.randint(0, 9))) for _ in range(120)]
    rows += [(1, date(2020, 2, 3), D(5))] * 50 + [(None, date(2020, 1, 1), D(1)), (1, None, D(1)), (2, date(2020, 1, 1), None)]
    want = []
    for account in (1, 2, 3):
        own = sorted((d, b) for a, d, b in rows if a == account and d is not None and b is not None)
        want += [(account, d, b.quantize(D("1.0000")), abs(b - p).quantize(D("1.0000")))
                 for (d, b), (_, p) in zip(own[1:], own) if abs(b - p) > 0]
    got = anomaly.daily_changes(frame(BAL, *rows), workspace).where("change > 0")
    assert rows_of(got, "account_id", "day", "balance", "change") == sorted(want, key=repr)


@pytest.mark.parametrize("shape", ["normal", "ties", "tail"])
def test_quartiles_of_large_and_small_accounts(spark, workspace, shape):
    rng = np.random.default_rng(7)
    sizes = {1: 30_000, 2: 5_000, 3: 4_999, 4: 5, 5: 4, 6: 20_001}
    draw = {"normal": lambda n: rng.normal(0, 1000, n), "ties": lambda n: rng.integers(0, 3, n).astype(float),
            "tail": lambda n: rng.pareto(0.5, n) * 10}[shape]
    values = {a: np.round(np.minimum(draw(n), 1e12), 2) for a, n in sizes.items()}
    pdf = pd.DataFrame({"account_id": np.repeat(list(sizes), list(sizes.values())), "balance": np.concatenate(list(values.values()))})
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).withColumn("day", F.lit("2020-01-01").cast("date")).repartition(8)
    got = {r.account_id: (r.q1, r.q3) for r in anomaly.account_quartiles(df, workspace).collect()}
    for account, own in values.items():
        assert got[account] == pytest.approx(np.quantile(own, [0.25, 0.75]), rel=1e-12)
    outliers = anomaly.account_outliers(df, workspace, 2.0)
    n = {r.account_id: (r.z, r.i) for r in outliers.groupBy("account_id").agg(
        F.count_if("z_outlier").alias("z"), F.count_if("iqr_outlier").alias("i")).collect()}
    for account, own in values.items():
        spread = own.std()
        z = 0 if len(own) < 5 or spread == 0 else int((np.abs((own - own.mean()) / spread) > 2).sum())
        q1, q3 = np.quantile(own, [0.25, 0.75])
        i = 0 if len(own) < 5 or q1 == q3 else int(((own < q1 - 1.5 * (q3 - q1)) | (own > q3 + 1.5 * (q3 - q1))).sum())
        assert n[account] == (z, i)


@pytest.fixture
def small_partitions(spark):
    """Range partitions of a megabyte, so a million rows span several."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_quartiles_of_one_account_of_a_million_rows(spark, workspace, small_partitions):
    """The account is cut over many partitions and no window spans it."""
    n = 1_000_000
    value = (F.col("id") * 7919 % 1_000_003).cast("double") / 100
    big = spark.range(n).select(F.lit(1).cast("bigint").alias("account_id"), value.alias("balance"))
    rest = spark.range(40).select((F.col("id") % 8 + 2).alias("account_id"), F.col("id").cast("double").alias("balance"))
    nulls = spark.range(5).select(F.lit(None).cast("bigint").alias("account_id"), F.lit(1.0).alias("balance"))
    df = big.unionByName(rest).unionByName(nulls).withColumn("day", F.lit("2020-01-01").cast("date"))
    got = {r.account_id: (r.n, r.q1, r.q3) for r in anomaly.account_quartiles(df, workspace).collect()}
    own = np.arange(n, dtype=np.int64) * 7919 % 1_000_003 / 100
    assert got[1] == (n, *np.quantile(own, [0.25, 0.75]))
    for a in range(2, 10):
        assert got[a] == (5, *np.quantile(np.arange(a - 2, 40, 8.0), [0.25, 0.75]))
    assert set(got) == set(range(1, 10))
    counted = big.groupBy("account_id", "balance").agg(F.count("*").alias("n"))
    placed = placed_rows(counted, ["account_id", "balance"], "spread", workspace)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < n / 3
    plan = anomaly.account_quartiles(df, workspace)._jdf.queryExecution().optimizedPlan().toString()
    over_counts = [line for line in plan.split("\n") if "Window [" in line and "sum(_n#" in line]
    assert len(over_counts) == 1 and "windowspecdefinition(_part" in over_counts[0] and "raise_error" not in plan


def test_quantiles_at_the_ends_and_of_one_value(spark, workspace):
    df = spark.createDataFrame([("a", 1.0), ("a", 9.0), ("b", 4.0), ("c", None), (None, 2.0)], "g string, v double")
    got = {r.g: (r.n, r.quantiles) for r in group_quantiles(df, "g", "v", [0.0, 0.5, 1.0], workspace).collect()}
    assert got == {"a": (2, [1.0, 5.0, 9.0]), "b": (1, [4.0, 4.0, 4.0])}
    assert group_quantiles(df.where("false"), "g", "v", [0.5], workspace).collect() == []


def test_z_scores_read_no_quartiles(frame, workspace):
    df = frame(BAL, *[(1, "2020-01-01", v) for v in (1, 2, 3, 4, 10)])
    scored = anomaly.z_scores(df, workspace)
    own = np.array([1.0, 2, 3, 4, 10])
    assert sorted(r.z_score for r in scored.collect()) == pytest.approx(sorted((own - own.mean()) / own.std()))
    assert "_part" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_flat_and_short_accounts_have_no_outliers(frame, workspace):
    df = frame(BAL, *[(1, "2020-01-01", 5)] * 9, *[(2, "2020-01-01", v) for v in (1, 1, 1, 999)])
    assert anomaly.account_outliers(df, workspace, 1.0).where("z_outlier or iqr_outlier").count() == 0


def test_z_score_names_a_flag_that_both_tests_find(frame, workspace):
    df = frame(BAL, *[(1, "2020-01-01", v) for v in [1, 2, 3, 4, 5] * 4 + [500]])
    got = anomaly.statistical_outliers(anomaly.account_outliers(df, workspace))
    assert rows_of(got, "anomaly_type", "balance", "threshold_value") == [("STATISTICAL_OUTLIER_Z_SCORE", D("500.00"), 3.0)]


def test_concentrations_break_ties_by_key_and_skip_missing_keys(frame):
    breaks = frame("account_id bigint;break_category string;dollar_exposure decimal(19,4)", (4, "B", 10), (3, "B", 10), (2, "A", 10),
                   (1, "A", 10), (None, "C", 999), (9, None, None))
    assert [r.account_id for r in anomaly.break_concentration_account(breaks).orderBy("_rank").collect()] == [1, 2, 3]
    assert rows_of(anomaly.break_concentration_category(breaks), "_rank", "amount", "review_action") == [
        (1, D("2.00"), "Review systemic cause of frequent 'A' breaks"), (2, D("2.00"), "Review systemic cause of frequent 'B' breaks"),
        (3, D("1.00"), "Review systemic cause of frequent 'C' breaks")]
    log = frame("severity string;root_cause string", ("HIGH", "z"), ("HIGH", "a"), ("HIGH", None), ("CRITICAL", "a"), ("CRITICAL", "c"))
    assert rows_of(anomaly.exception_concentration(log), "_rank", "amount") == [(1, D("1.00")), (2, D("1.00"))]


def test_optional_inputs_resolve_their_columns(frame, workspace):
    cash = frame("account_id bigint;transaction_amount string;trade_date string", (1, "10000.01", "2020-01-01"), (1, "-20000", "bad"), (1, "x", None))
    assert rows_of(anomaly.large_cash_transactions(cash), "amount", "transaction_date") == [(D("-20000.00"), None), (D("10000.01"), "2020-01-01")]
    assert anomaly.large_cash_transactions(cash.select("account_id")) is None
    assert anomaly.ledger_anomalies(cash.select("account_id"), workspace) == []
    dated = frame("account_id bigint;ledger_date date;cash_balance decimal(19,4)", (1, "2020-01-01", 0), (1, "2020-01-02", 30000))
    kinds = [rows_of(part, "anomaly_type") for part in anomaly.ledger_anomalies(dated, workspace)]
    assert kinds == [[("LEDGER_EXCESS_BALANCE",)], [("LEDGER_LARGE_DAILY_MOVEMENT",)]]


def test_flags_without_inputs_and_with_some(frame, workspace):
    assert anomaly.anomaly_flags(workspace, None, None, None) is None
    log = frame("severity string;root_cause string", ("HIGH", "a"))
    got = anomaly.anomaly_flags(workspace, None, None, log)
    assert rows_of(got, "anomaly_id", "anomaly_type", "account_id") == [(1, "HIGH_EXCEPTION_CONCENTRATION", None)]
    assert rows_of(anomaly.anomaly_summary(got), "record_count", "unique_accounts", "total_amount", "avg_balance") == [(1, 0, D("1.00"), None)]


def test_validation_summary_texts(frame, spark):
    flags = frame("severity string", *[("HIGH",)] * 1200, ("LOW",))
    vendor = frame("severity string", ("HIGH",), ("MEDIUM",))
    quality = frame("severity string;check_status string", ("HIGH", "FAIL"), ("INFO", "PASS"), ("INFO", "PASS"))
    got = anomaly.validation_summary("2020-01-01", flags, vendor, quality).collect()
    a, v, q = (next(r for r in got if r.checks_performed == n) for n in (8, 6, 3))
    assert (a.failed_checks, a.anomaly_count, a.pass_rate, a.notes) == (0, 1201, None, "1,201 anomaly flags generated for review; 1,200 HIGH severity")
    assert (v.failed_checks, v.pass_rate, v.notes) == (2, 0.0, "2 validation issues; 1 HIGH severity")
    assert (q.failed_checks, q.high_risk_count, q.pass_rate, q.notes) == (1, 1, 66.7, "1 of 3 checks failed; 1 HIGH severity failures")
    failed = anomaly.validation_summary("2020-01-01", None, vendor.limit(0), quality).collect()
    assert failed[0].notes == "Module anomaly_detection failed to complete" and failed[1].pass_rate == 100.0
