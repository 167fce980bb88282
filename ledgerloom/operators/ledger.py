"""Dense daily balances and positions from sparse movements.

A dense day grid is never shuffled or joined. Movements are summed per key and day, the running
total is taken over those few rows, and each row is then stretched over the days until the next
one. A key has at most one row per calendar day, so no window group grows with the number of
transactions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import MONEY, SHARES, money


def day_span(transactions: DataFrame, date_column: str = "transaction_date",
             max_days: int | None = None) -> DataFrame:
    """One row with the first and last day. With ``max_days`` a longer span is an error, for data whose dates may be wrong."""
    lo, hi = F.min(date_column).alias("first_day"), F.max(date_column).alias("last_day")
    if max_days is None:
        return transactions.agg(lo, hi)
    checked = F.when(F.date_diff(F.max(date_column), F.min(date_column)) > max_days, F.raise_error(F.lit("calendar too long")).cast("date"))
    return transactions.agg(F.coalesce(checked, F.min(date_column)).alias("first_day"), hi)


def _span_column(transactions: DataFrame, date_column: str, max_days: int | None) -> tuple[Column, Column]:
    span = day_span(transactions, date_column, max_days).select(F.struct("first_day", "last_day").alias("span"))
    once = span.scalar()
    return once.getField("first_day"), once.getField("last_day")


def calendar(transactions: DataFrame, date_column: str = "transaction_date",
             max_days: int | None = None) -> DataFrame:
    """Every day from the first to the last transaction; no rows without transactions."""
    span = day_span(transactions, date_column, max_days)
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("calendar_date"))


def daily_net_cash(cash: DataFrame) -> DataFrame:
    return (cash.groupBy("account_id", "transaction_date")
            .agg(F.sum("cash_impact").cast(MONEY).alias("daily_net_cash")))


def daily_net_shares(trades: DataFrame) -> DataFrame:
    return (trades.groupBy("account_id", "ticker", "transaction_date")
            .agg(F.sum("security_impact").cast(SHARES).alias("daily_net_shares")))


def first_trade(trades: DataFrame) -> DataFrame:
    return trades.groupBy("account_id", "ticker").agg(F.min("transaction_date").alias("first_trade_date"))


def account_date_grid(accounts: DataFrame, cash: DataFrame,
                      max_days: int | None = None) -> DataFrame:
    """Every account on every calendar day, generated per account instead of cross joined."""
    lo, hi = _span_column(cash, "transaction_date", max_days)
    return accounts.select("account_id", F.explode(F.sequence(lo, hi)).alias("calendar_date"))


def position_grid(trades: DataFrame, max_days: int | None = None) -> DataFrame:
    """Every account and ticker on every day from its first trade on."""
    _, hi = _span_column(trades, "transaction_date", max_days)
    return first_trade(trades).where("account_id is not null and ticker is not null").select(
        "account_id", "ticker", F.explode(F.sequence("first_trade_date", hi)).alias("calendar_date"))


def ledger_balances(cash: DataFrame, accounts: DataFrame, max_days: int | None = None) -> DataFrame:
    """Cash balance of every account on every day, idle accounts at zero.

    Each account is seeded with a zero balance on the first day, so the grid needs no join.
    Movements of unknown accounts are left out.
    """
    lo, hi = _span_column(cash, "transaction_date", max_days)
    opening = accounts.select("account_id", lo.alias("ledger_date"), F.lit(0).cast(MONEY).alias("opening"))
    return ledger_from(opening, cash, hi)


def ledger_from(opening: DataFrame, cash: DataFrame, last_day: Column) -> DataFrame:
    """Balances from the opening day on: ``opening`` holds ``account_id``, ``ledger_date`` and the balance before that day.

    Movements must not lie before the opening day; those of accounts without an opening are left out.
    """
    nothing = F.lit(0).cast(MONEY)
    moves = cash.select("account_id", F.col("transaction_date").alias("ledger_date"),
                        F.col("cash_impact").alias("amount"), F.lit(None).cast(MONEY).alias("opening"))
    daily = (
        opening.select("account_id", "ledger_date", nothing.alias("amount"), "opening")
        .unionByName(moves).where("ledger_date is not null and account_id is not null")
        .groupBy("account_id", "ledger_date")
        .agg(F.sum("amount").cast(MONEY).alias("movement"), F.max("opening").alias("opening"))
    )
    in_order = Window.partitionBy("account_id").orderBy("ledger_date")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select(
        "account_id", "ledger_date", "movement",
        # The opening sits on the first day, so a known account starts with it.
        (F.first("opening").over(so_far) + F.sum("movement").over(so_far)).cast(MONEY).alias("cash_balance"),
        F.lead("ledger_date").over(in_order).alias("next_date"),
    ).where("cash_balance is not null")
    until = F.coalesce(F.date_sub("next_date", 1), last_day)
    return running.select(
        "account_id", "cash_balance", "movement", F.col("ledger_date").alias("moved_on"),
        F.explode(F.sequence("ledger_date", until)).alias("ledger_date"),
    ).select(
        "account_id", "ledger_date",
        F.when(F.col("ledger_date") == F.col("moved_on"), F.col("movement")).otherwise(nothing).alias("daily_net_cash"),
        "cash_balance",
    )


def positions(trades: DataFrame, max_days: int | None = None) -> DataFrame:
    """Share count of every account and ticker per day, where it is held or moved that day."""
    _, hi = _span_column(trades, "transaction_date", max_days)
    return positions_from(None, trades, hi)


def positions_from(opening: DataFrame | None, trades: DataFrame, last_day: Column) -> DataFrame:
    """Share counts from the opening day on: ``opening`` holds ``account_id``, ``ticker``, ``transaction_date`` and the
    shares held before that day. Trades must not lie before it; without ``opening`` nothing is held."""
    nothing = F.lit(0).cast(SHARES)
    daily = daily_net_shares(trades.where("account_id is not null and ticker is not null")).withColumn("opening", nothing)
    if opening is not None:
        seeds = opening.select("account_id", "ticker", "transaction_date", nothing.alias("daily_net_shares"), "opening")
        daily = daily.unionByName(seeds).groupBy("account_id", "ticker", "transaction_date").agg(
            F.sum("daily_net_shares").cast(SHARES).alias("daily_net_shares"), F.sum("opening").cast(SHARES).alias("opening"))
    key = Window.partitionBy("account_id", "ticker").orderBy("transaction_date")
    so_far = F.col("daily_net_shares") + F.col("opening")
    running = (
        daily.select(
            "account_id", "ticker", "transaction_date", F.col("daily_net_shares").alias("movement"),
            F.sum(so_far).over(key.rowsBetween(Window.unboundedPreceding, 0)).cast(SHARES).alias("share_quantity"),
            F.lead("transaction_date").over(key).alias("next_date"),
        )
        .where("share_quantity <> 0 or movement <> 0")
    )
    # A closed position shows only on the day it was closed.
    until = (F.when(F.col("share_quantity") == 0, F.col("transaction_date"))
             .otherwise(F.coalesce(F.date_sub("next_date", 1), last_day)))
    return running.select(
        "account_id", "ticker", "share_quantity", "movement", "transaction_date",
        F.explode(F.sequence("transaction_date", until)).alias("position_date"),
    ).select(
        "account_id", "ticker", "position_date",
        F.when(F.col("position_date") == F.col("transaction_date"), F.col("movement")).otherwise(nothing).alias("daily_net_shares"),
        "share_quantity",
    )


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    """The frame with the first day of the month as ``month``; as it is where it has that column."""
    return df if "month" in df.columns else df.withColumn("month", F.trunc(date_column, "MM"))


def month_openings(ledger: DataFrame) -> DataFrame:
    """For each account and month with rows the date and balance of the account's last row before that month.

    Closing rows are one for each account and month, so the look-back over an account spans its months, not its days.
    """
    last = F.max_by(F.struct("ledger_date", "cash_balance"), "ledger_date")
    closing = with_month(ledger, "ledger_date").groupBy("account_id", "month").agg(last.alias("closing"))
    before = F.lag("closing").over(Window.partitionBy("account_id").orderBy("month"))
    return closing.select("account_id", "month", before.getField("ledger_date").alias("opened_on"),
                          before.getField("cash_balance").alias("opening_balance"))


def month_moves(cash: DataFrame) -> DataFrame:
    """Daily movements with their month."""
    return with_month(daily_net_cash(cash), "transaction_date")


def _rolled(ledger: DataFrame, moves: DataFrame, openings: DataFrame) -> DataFrame:
    """Ledger rows with the account's row before each and the day's movement.

    All meet by account and month: inside a month the row before comes from a window over at most its days, and the month's first
    row takes it from the opening. Layers bucketed by account and month are read where they lie.
    """
    in_month = Window.partitionBy("account_id", "month").orderBy("ledger_date")
    rows = with_month(ledger, "ledger_date").select("account_id", "month", "ledger_date", "cash_balance")
    dated = moves.select("account_id", "month", F.col("transaction_date").alias("ledger_date"), F.col("daily_net_cash").alias("movement"))
    joined = rows.join(openings, ["account_id", "month"], "left").join(dated, ["account_id", "month", "ledger_date"], "left")
    lag = lambda c, other: F.coalesce(F.lag(c).over(in_month), other)
    return joined.select(
        "account_id", "ledger_date", "cash_balance", F.coalesce("movement", F.lit(0).cast(MONEY)).alias("movement"),
        lag("ledger_date", F.col("opened_on")).alias("prior_date"), lag("cash_balance", F.col("opening_balance")).alias("prior"))


def rollforward_breaks(ledger: DataFrame, cash: DataFrame, tolerance: str = fixed.ROLLFORWARD_TOLERANCE,
                       moves: DataFrame | None = None, openings: DataFrame | None = None) -> DataFrame:
    """Days whose balance is not the balance of the day before plus the day's movement.

    Only the row of the day before counts, so a missing day shows as a break on the day after it. An account has at most one row
    a day. ``moves`` and ``openings`` are ``month_moves`` and ``month_openings`` where they are written already.
    """
    moves = month_moves(cash) if moves is None else moves
    openings = month_openings(ledger) if openings is None else openings
    zero = F.lit(0).cast(MONEY)
    yesterday = F.when(F.col("prior_date") == F.date_sub("ledger_date", 1), F.col("prior"))
    joined = _rolled(ledger, moves, openings).select(
        "account_id", "ledger_date", F.coalesce(yesterday, zero).alias("prior_balance"),
        F.col("movement").alias("daily_movement"), F.col("cash_balance").alias("ending_balance"))
    return (
        joined.withColumn("calculated_ending_balance",
                          (F.col("prior_balance") + F.col("daily_movement")).cast(MONEY))
        .withColumn("variance", (F.col("calculated_ending_balance") - F.col("ending_balance")).cast(MONEY))
        .where(F.abs("variance") > money(tolerance))
        .select(F.lit("Roll-Forward Failure").alias("check_name"), "account_id", "ledger_date", "prior_balance", "daily_movement",
                "calculated_ending_balance", "ending_balance", "variance")
    )


def rollforward_lag_tieout(ledger: DataFrame, cash: DataFrame, tolerance: str = fixed.LAG_TIEOUT_TOLERANCE,
                           moves: DataFrame | None = None, openings: DataFrame | None = None) -> DataFrame:
    """The same tie-out against the account's previous row, whatever its date."""
    moves = month_moves(cash) if moves is None else moves
    openings = month_openings(ledger) if openings is None else openings
    gap = F.coalesce("prior_cash_balance", F.lit(0).cast(MONEY)) + F.col("daily_cash_movement") - F.col("ending_cash_balance")
    return (
        _rolled(ledger, moves, openings).select(
            "account_id", "ledger_date", F.col("prior").alias("prior_cash_balance"), F.col("movement").alias("daily_cash_movement"),
            F.col("cash_balance").alias("ending_cash_balance"))
        .withColumn("tie_out_difference", F.round(gap, 2))
        .where(F.abs("tie_out_difference") > money(tolerance))
    )
