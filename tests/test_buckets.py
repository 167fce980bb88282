"""Layers bucketed by account and month are compared and rolled forward where they lie."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ledger, recon
from ledgerloom.sources.workspace import Workspace
from tests.conftest import rows_of


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def space(spark):
    own = Workspace(spark)
    yield own
    own.drop()


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"\bExchange .*|BroadcastExchange.*", plan)


@pytest.fixture
def cash(spark):
    """Transactions of 40 accounts over 200 days, a third of them of one account."""
    account = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40)
    return spark.range(2000).select(account.alias("account_id"), F.date_add(F.lit("2020-01-10").cast("date"), (F.col("id") * 31 % 200).cast("int")).alias("transaction_date"),
                                    (F.col("id") % 11 - 5).cast("decimal(19,4)").alias("cash_impact"))


@pytest.fixture
def book(spark, cash):
    return ledger.ledger_balances(cash, spark.range(40).withColumnRenamed("id", "account_id"))


def custodian_of(book):
    value = F.when(F.col("account_id") == 7, F.col("cash_balance") + 2).otherwise(F.col("cash_balance"))
    return book.where("not (account_id = 3 and ledger_date = '2020-03-03')").select(
        F.when(F.col("account_id") == 5, 905).otherwise(F.col("account_id")).alias("account_id"),
        F.col("ledger_date").alias("balance_date"), value.cast("decimal(19,4)").alias("custodian_cash_balance"), F.lit(1).alias("injection_id"))


def test_cash_books_meet_without_an_exchange(space, book, no_broadcast):
    custodian = custodian_of(book)
    keys = ["account_id", "month"]
    own = space.write_bucketed(ledger.with_month(book, "ledger_date"), "own", keys)
    theirs = space.write_bucketed(ledger.with_month(custodian, "balance_date"), "theirs", keys)
    compared = recon.cash_recon(own, theirs)
    assert rows_of(compared) == rows_of(recon.cash_recon(book, custodian))
    assert exchanges(compared) == []
    assert {r[0] for r in compared.select("break_type").distinct().collect()} == {
        "MATCHED", "CASH_BALANCE_BREAK", "MISSING_IN_CUSTODIAN", "MISSING_IN_INTERNAL"}


def test_position_books_meet_without_an_exchange(spark, space, no_broadcast):
    held = spark.range(6000).select((F.col("id") % 9).alias("account_id"), F.concat(F.lit("T"), F.col("id") % 4).alias("ticker"),
                                    F.date_add(F.lit("2020-01-10").cast("date"), F.floor(F.col("id") / 36).cast("int")).alias("position_date"),
                                    F.col("id").cast("decimal(28,8)").alias("share_quantity"))
    custodian = held.where("account_id <> 2").withColumnRenamed("share_quantity", "custodian_share_quantity")
    keys = ["account_id", "ticker", "month"]
    own, theirs = (space.write_bucketed(ledger.with_month(df, "position_date"), n, keys) for n, df in (("own", held), ("theirs", custodian)))
    compared = recon.position_recon(own, theirs)
    assert rows_of(compared) == rows_of(recon.position_recon(held, custodian)) and exchanges(compared) == []


def test_roll_forward_checks_read_the_ledger_without_an_exchange(space, book, cash, no_broadcast):
    gone = "account_id = 6 and ledger_date in ('2020-02-01', '2020-03-15', '2020-04-30')"
    off = F.when((F.col("account_id") == 7) & (F.col("ledger_date") == "2020-05-31"), F.col("cash_balance") + 1).otherwise(F.col("cash_balance"))
    dented = book.where(f"not ({gone})").withColumn("cash_balance", off.cast("decimal(19,4)"))
    keys = ["account_id", "month"]
    own = space.write_bucketed(ledger.with_month(dented, "ledger_date"), "own", keys)
    moves = space.write_bucketed(ledger.month_moves(cash), "moves", keys)
    openings = space.write_bucketed(ledger.month_openings(own), "openings", keys)
    for check in (ledger.rollforward_breaks, ledger.rollforward_lag_tieout):
        found = check(own, cash, moves=moves, openings=openings)
        assert rows_of(found) == rows_of(check(dented, cash)) and exchanges(found) == []
    days = {(r.account_id, str(r.ledger_date)) for r in ledger.rollforward_breaks(own, cash, moves=moves, openings=openings).collect()}
    assert {(7, "2020-05-31"), (7, "2020-06-01")} <= days <= {(7, "2020-05-31"), (7, "2020-06-01"), (6, "2020-02-02"), (6, "2020-03-16"), (6, "2020-05-01")}


def test_buckets_of_a_hot_account_are_even(spark, space, cash):
    """Its months go to different buckets, and an account has one row a day."""
    book = ledger.ledger_balances(cash, spark.range(1).select(F.lit(7).cast("bigint").alias("account_id")))
    own = space.write_bucketed(ledger.with_month(book, "ledger_date"), "hot", ["account_id", "month"])
    files = {f.split("_")[-1] for f in own.select(F.col("_metadata.file_name").alias("f")).distinct().toPandas().f}
    assert len(files) >= 4
