"""Tables by month: a rebuild from a month on equals a full one, and dated readers read their months only."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest

from ledgerloom.operators import ledger, months
from ledgerloom.sources.tables import months_of
from tests.conftest import rows_of

CASH = "account_id bigint;transaction_date date;cash_impact decimal(19,4)"
TRADES = "account_id bigint;ticker string;transaction_date date;security_impact decimal(28,8)"
START = date(2020, 1, 10)


def cash_rows(seed, n=90, days=200):
    rng = random.Random(seed)
    rows = [(rng.randint(1, 4), START + timedelta(rng.randint(0, days)), D(rng.randint(-50, 50))) for _ in range(n)]
    return rows + [(1, START, D(5)), (2, START + timedelta(days), D(7))]


def same_ledger(spark, path, cash, accounts):
    assert rows_of(months.read_ledger(spark, path)) == rows_of(ledger.ledger_balances(cash, accounts))


@pytest.mark.parametrize("late", [date(2020, 4, 2), date(2020, 7, 28), date(2020, 9, 15), date(2020, 1, 12), date(2019, 12, 30)])
def test_late_transaction_rewrites_its_month_and_later_ones(spark, frame, workspace, late, tmp_path):
    """In the middle, in the last month, beyond the end, in the first month and before it."""
    path, accounts, rows = str(tmp_path / "ledger"), frame("account_id bigint", (1,), (2,), (3,), (9,), (None,)), cash_rows(3)
    months.rebuild_ledger(path, frame(CASH, *rows), accounts, workspace)
    same_ledger(spark, path, frame(CASH, *rows), accounts)
    files = {m: {f.name for f in (tmp_path / "ledger" / f"year_month={m}").iterdir()} for m in months_of(spark, path)}
    rows.append((3, late, D("12.5")))
    start = months.rebuild_ledger(path, frame(CASH, *rows), accounts, workspace, changed=late)
    same_ledger(spark, path, frame(CASH, *rows), accounts)
    untouched = {m for m, names in files.items() if names == {f.name for f in (tmp_path / "ledger" / f"year_month={m}").iterdir()}}
    assert untouched == {m for m in files if m < f"{start:%Y-%m}"}
    assert start == max(min(late.replace(day=1), date(2020, 7, 1)), min(START, late))


def test_transactions_that_go_and_accounts_that_come_and_go(spark, frame, workspace, tmp_path):
    path, rows = str(tmp_path / "ledger"), cash_rows(5)
    few, more = frame("account_id bigint", (1,), (2,)), frame("account_id bigint", (1,), (2,), (4,), (8,))
    months.rebuild_ledger(path, frame(CASH, *rows), few, workspace)
    # the last two months lose all they had: the table ends earlier
    shorter = [r for r in rows if r[1] < date(2020, 6, 1)]
    months.rebuild_ledger(path, frame(CASH, *shorter), few, workspace, changed=date(2020, 6, 1))
    same_ledger(spark, path, frame(CASH, *shorter), few)
    # accounts come, one of them with movements in months that stay; doing it again changes nothing
    for _ in range(2):
        assert months.rebuild_ledger(path, frame(CASH, *shorter), more, workspace, changed=date(2020, 5, 20)) == date(2020, 5, 1)
        same_ledger(spark, path, frame(CASH, *shorter), more)
    assert months.rebuild_ledger(path, frame(CASH, *shorter), few, workspace, changed=date(2020, 5, 20)) == START
    same_ledger(spark, path, frame(CASH, *shorter), few)
    assert months.rebuild_ledger(path, frame(CASH, *shorter).where("false"), few, workspace) is None


@pytest.mark.parametrize("late", [date(2020, 4, 2), date(2020, 9, 15), date(2020, 1, 12), date(2019, 12, 30)])
def test_positions_rebuilt_in_part(spark, frame, workspace, late, tmp_path):
    rng, path = random.Random(6), str(tmp_path / "positions")
    rows = [(rng.randint(1, 3), rng.choice("AB"), START + timedelta(rng.randint(0, 200)), D(rng.randint(-2, 2))) for _ in range(60)]
    months.rebuild_positions(path, frame(TRADES, *rows), workspace)
    for change in [(2, "B", late, D(3)), (None, "A", late, D(1)), (5, "Z", late, D(-1))]:
        rows.append(change)
        months.rebuild_positions(path, frame(TRADES, *rows), workspace, changed=late)
        assert rows_of(months.read_positions(spark, path)) == rows_of(ledger.positions(frame(TRADES, *rows)))


def test_months_without_positions_lose_their_rows(spark, frame, workspace, tmp_path):
    path = str(tmp_path / "positions")
    rows = [(1, "A", date(2020, 1, 5), D(2)), (1, "A", date(2020, 6, 5), D(-2))]
    months.rebuild_positions(path, frame(TRADES, *rows), workspace)
    rows.append((1, "A", date(2020, 2, 10), D(-2)))
    rows.append((1, "A", date(2020, 6, 5), D(2)))
    months.rebuild_positions(path, frame(TRADES, *rows), workspace, changed=date(2020, 2, 10))
    assert rows_of(months.read_positions(spark, path)) == rows_of(ledger.positions(frame(TRADES, *rows)))
    assert months_of(spark, path) == ["2020-01", "2020-02"]


def test_dated_readers_read_their_months_only(spark, frame, workspace, tmp_path):
    path, accounts, rows = str(tmp_path / "ledger"), frame("account_id bigint", (1,), (2,)), cash_rows(8)
    months.rebuild_ledger(path, frame(CASH, *rows), accounts, workspace)
    first, last = date(2020, 3, 20), date(2020, 4, 2)
    part = months.read_ledger(spark, path, first, last)
    assert part.columns == ["account_id", "ledger_date", "daily_net_cash", "cash_balance"]
    assert rows_of(part) == rows_of(ledger.ledger_balances(frame(CASH, *rows), accounts).where(f"ledger_date between '{first}' and '{last}'"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "2020-03" in plan and "2020-04" in plan
    assert {f.split("year_month=")[1][:7] for f in (r.f for r in part.selectExpr("_metadata.file_path f").distinct().collect())} == {"2020-03", "2020-04"}
