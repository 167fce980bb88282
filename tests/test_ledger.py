import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ledger
from tests.conftest import rows_of


@pytest.fixture
def cash(frame):
    return lambda *rows: frame("account_id bigint;transaction_date date;cash_impact decimal(19,4)", *rows)


def days(first, last):
    return [first + timedelta(n) for n in range((last - first).days + 1)]


def test_balances_equal_a_day_by_day_loop(frame, cash):
    rng = random.Random(5)
    start = date(2020, 1, 1)
    moves = [(rng.randint(1, 4), start + timedelta(rng.randint(0, 60)), D(rng.randint(-500, 500))) for _ in range(80)]
    moves.append((99, start, D(7)))  # no such account
    got = ledger.ledger_balances(cash(*moves), frame("account_id bigint", (1,), (2,), (3,), (4,), (5,)))
    last = max(m[1] for m in moves)
    want = []
    for account in range(1, 6):
        total = D(0)
        for day in days(start, last):
            moved = sum((m[2] for m in moves if m[0] == account and m[1] == day), D(0))
            total += moved
            want.append((account, day, moved, total))
    assert rows_of(got, "account_id", "ledger_date", "daily_net_cash", "cash_balance") == sorted(want, key=repr)


def test_no_transactions_give_no_ledger(frame, cash):
    empty = cash((1, "2020-01-01", 1)).where("account_id > 1")
    assert ledger.ledger_balances(empty, frame("account_id bigint", (1,))).count() == 0
    assert ledger.calendar(empty).count() == 0


def test_long_calendar_is_refused_only_on_request(frame, cash):
    wild = cash((1, "1900-01-01", 1), (1, "2200-01-01", 1))
    accounts = frame("account_id bigint", (1,))
    assert ledger.ledger_balances(wild, accounts).count() == (date(2200, 1, 1) - date(1900, 1, 1)).days + 1
    with pytest.raises(Exception, match="calendar too long"):
        ledger.ledger_balances(wild, accounts, max_days=30_000).collect()


def test_positions_equal_a_day_by_day_loop(frame):
    rng = random.Random(6)
    start = date(2020, 1, 1)
    trades = [(rng.randint(1, 3), rng.choice("AB"), start + timedelta(rng.randint(0, 40)), D(rng.randint(-2, 2))) for _ in range(60)]
    df = frame("account_id bigint;ticker string;transaction_date date;security_impact decimal(28,8)", *trades)
    last = max(t[2] for t in trades)
    want = []
    for key in {(t[0], t[1]) for t in trades}:
        own = defaultdict(D)
        for a, k, day, n in trades:
            if (a, k) == key:
                own[day] += n
        total = D(0)
        for day in days(min(own), last):
            total += own.get(day, D(0))
            if total != 0 or own.get(day, D(0)) != 0:
                want.append((*key, day, total))
    assert rows_of(ledger.positions(df), "account_id", "ticker", "position_date", "share_quantity") == sorted(want, key=repr)


def test_rollforward_finds_a_bumped_day_twice_and_a_last_day_once(frame, cash):
    moves = cash((1, "2020-01-01", 10), (1, "2020-01-05", 5))
    good = ledger.ledger_balances(moves, frame("account_id bigint", (1,)))
    assert ledger.rollforward_breaks(good, moves).count() == 0
    assert ledger.rollforward_lag_tieout(good, moves).count() == 0
    bump = lambda day, by: good.withColumn("cash_balance", F.when(
        F.col("ledger_date") == day, F.col("cash_balance") + D(by)).otherwise(F.col("cash_balance")).cast("decimal(19,4)"))
    assert ledger.rollforward_breaks(bump("2020-01-03", "1"), moves).count() == 2
    assert ledger.rollforward_breaks(bump("2020-01-05", "1"), moves).count() == 1
    assert ledger.rollforward_breaks(bump("2020-01-03", "0.001"), moves).count() == 0  # exactly the tolerance
    assert ledger.rollforward_lag_tieout(bump("2020-01-03", "1"), moves).count() == 2
    assert ledger.rollforward_lag_tieout(bump("2020-01-03", "0.01"), moves).count() == 0


def test_a_missing_day_breaks_by_date_but_not_by_lag(frame, cash):
    moves = cash((1, "2020-01-01", 10), (1, "2020-01-05", 5))
    holed = ledger.ledger_balances(moves, frame("account_id bigint", (1,))).where("ledger_date <> '2020-01-03'")
    assert rows_of(ledger.rollforward_breaks(holed, moves), "ledger_date") == [(date(2020, 1, 4),)]
    assert ledger.rollforward_lag_tieout(holed, moves).count() == 0


def test_the_day_grid_is_neither_shuffled_nor_cross_joined(frame, cash):
    df = ledger.ledger_balances(cash((1, "2020-01-01", 10)), frame("account_id bigint", (1,)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate explode")]
    assert "Exchange" not in above and "CartesianProduct" not in plan and "NestedLoop" not in plan
