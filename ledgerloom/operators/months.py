"""Ledger and positions as tables by month that are rebuilt from a month on.

A month's rows follow from what stood at the end of the month before and the movements since. So a
late transaction rewrites its own month and those after it: balances at the border are read from
the month before, and months before it stay as they are. The result is that of a full rebuild.
"""

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, SHARES
from ledgerloom.operators.ledger import ledger_balances, ledger_from, positions, positions_from
from ledgerloom.sources.tables import drop_months_after, months_of, read_months, write_by_month
from ledgerloom.sources.workspace import Workspace

LEDGER = f"account_id bigint, ledger_date date, daily_net_cash {MONEY}, cash_balance {MONEY}"
POSITIONS = f"account_id bigint, ticker string, position_date date, daily_net_shares {SHARES}, share_quantity {SHARES}"


@dataclass(frozen=True)
class Span:
    """First and last day of something; both ``None`` when it is empty."""
    first: date | None
    last: date | None


def _span(df: DataFrame, column: str) -> Span:
    return Span(*df.agg(F.min(column), F.max(column)).first())


def _table_span(spark: SparkSession, path: str, schema: str, column: str) -> Span:
    """First and last day of a table by month, from its first and last folder."""
    months = months_of(spark, path)
    if not months:
        return Span(None, None)
    of = lambda month: _span(spark.read.schema(schema).parquet(f"{path}/year_month={month}"), column)
    return Span(of(months[0]).first, of(months[-1]).last)


def _month(day: date) -> date:
    return day.replace(day=1)


def _first_stale(changed: date, held: Span, wanted: Span) -> date:
    """First day of the first month to write: of the change, of the day after the table's end, or of the new end if that is earlier."""
    return min(_month(changed), _month(held.last + timedelta(1)), _month(wanted.last))


def read_ledger(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    return read_months(spark, path, LEDGER, "ledger_date", first, last)


def read_positions(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    return read_months(spark, path, POSITIONS, "position_date", first, last)


def rebuild_ledger(path: str, cash: DataFrame, accounts: DataFrame, workspace: Workspace, changed: date | None = None) -> date | None:
    """Bring the ledger table up to date and return the first day written; ``None`` without any dated transaction.

    ``changed`` is the earliest date of a transaction that came, went or changed since the table was written. Without it, without a
    table, if the first day moved, or if an account went, all months are written. Accounts that are new get their
    earlier days added to the months that stay. A run that broke off can be run again with the same arguments.
    """
    spark, wanted = cash.sparkSession, _span(cash, "transaction_date")
    if wanted.first is None:
        return None
    held = _table_span(spark, path, LEDGER, "ledger_date")
    start = wanted.first if changed is None or held.first != wanted.first else _first_stale(changed, held, wanted)
    known = accounts.where("account_id is not null").select("account_id").distinct()
    if start > wanted.first:
        eve = start - timedelta(1)
        closing = workspace.write(read_ledger(spark, path, eve, eve).select("account_id", F.col("cash_balance").alias("opening")), "closing")
        if not closing.join(known, "account_id", "left_anti").isEmpty():
            start = wanted.first
    if start <= wanted.first:
        write_by_month(ledger_balances(cash, accounts), path, "ledger_date")
        drop_months_after(spark, path, f"{wanted.last:%Y-%m}")
        return wanted.first
    fresh = workspace.write(known.join(closing, "account_id", "left_anti"), "fresh-accounts")
    if not fresh.isEmpty():
        zero = fresh.select("account_id", F.lit(wanted.first).alias("ledger_date"), F.lit(0).cast(MONEY).alias("opening"))
        earlier = workspace.write(ledger_from(zero, cash.where(F.col("transaction_date") < F.lit(start)), F.lit(eve)), "fresh-rows")
        closing = closing.unionByName(earlier.where(F.col("ledger_date") == F.lit(eve)).select("account_id", F.col("cash_balance").alias("opening")))
        write_by_month(earlier, path, "ledger_date", append=True)
    opening = closing.select("account_id", F.lit(start).alias("ledger_date"), "opening")
    later = ledger_from(opening, cash.where(F.col("transaction_date") >= F.lit(start)), F.lit(wanted.last))
    write_by_month(later, path, "ledger_date", only_months_written=True)
    drop_months_after(spark, path, f"{wanted.last:%Y-%m}")
    return start


def rebuild_positions(path: str, trades: DataFrame, workspace: Workspace, changed: date | None = None) -> date | None:
    """As ``rebuild_ledger`` for positions, which stand only where shares are held or moved.

    A month in which nothing is held any more loses its rows, also when it had some before.
    """
    spark, wanted = trades.sparkSession, _span(trades, "transaction_date")
    if wanted.first is None:
        return None
    held = _table_span(spark, path, POSITIONS, "position_date")
    start = wanted.first if changed is None or held.first is None else _first_stale(changed, held, wanted)
    if start <= min(wanted.first, held.first or wanted.first):
        write_by_month(positions(trades), path, "position_date")
        return wanted.first
    eve = start - timedelta(1)
    opening = workspace.write(read_positions(spark, path, eve, eve).where("share_quantity <> 0").select(
        "account_id", "ticker", F.lit(start).alias("transaction_date"), F.col("share_quantity").alias("opening")), "opening-shares")
    later = workspace.write(positions_from(opening, trades.where(F.col("transaction_date") >= F.lit(start)), F.lit(wanted.last)), "later-positions")
    # A dynamic overwrite leaves months that have no rows now; those from the start on are taken away.
    kept = {r.m for r in later.select(F.date_format("position_date", "yyyy-MM").alias("m")).distinct().collect()}  # a row a month
    write_by_month(later, path, "position_date", only_months_written=True)
    drop_months_after(spark, path, f"{eve:%Y-%m}", keep=kept)
    return start
