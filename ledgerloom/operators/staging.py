"""Cleaning and classification of raw transactions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import (
    MONEY, PRICE, SHARES, blank_to_null, literal_frame, match_key, quoted,
)

_CLOCK = r"^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"


def transaction_id(row_id: Column, *candidates: Column) -> Column:
    """First non-blank candidate, else a generated id; ids shift columns when notes hold commas."""
    return F.coalesce(
        *[blank_to_null(c) for c in candidates],
        F.concat(F.lit(fixed.GENERATED_ID_PREFIX), row_id.cast("string")),
    )


def account_bucket(row_id: Column, accounts: int = fixed.SYNTHETIC_ACCOUNTS) -> Column:
    return F.pmod(row_id, F.lit(accounts)) + 1


def number_or_null(c: Column, kind: str, sentinel: str = fixed.UNAVAILABLE_TEXT) -> Column:
    """Decimal value, with the sentinel text read as missing rather than as a bad number."""
    return F.when(~match_key(c).eqNullSafe(sentinel.lower()), c).try_cast(kind)


def clock_time(c: Column) -> Column:
    """Valid time of day as ``HH:mm:ss`` text, else midnight."""
    text = F.trim(c)
    padded = F.lpad(F.when(F.length(text) <= 5, F.concat(text, F.lit(":00"))).otherwise(text), 8, "0")
    return F.when(text.rlike(_CLOCK), padded).otherwise(fixed.DEFAULT_TIME)


def invalid_date(c: Column) -> Column:
    """1 where no date can be read, missing text included."""
    return c.try_cast("date").isNull().cast("int")


def invalid_amount(c: Column) -> Column:
    """1 where text is present but is no amount."""
    return (c.isNotNull() & c.try_cast(MONEY).isNull()).cast("int")


def stage_clean(raw: DataFrame, accounts: int = fixed.SYNTHETIC_ACCOUNTS) -> DataFrame:
    """Typed, trimmed transactions with quality flags; one row per raw row, no shuffle."""
    amount = lambda name, kind: F.abs(quoted(name).try_cast(kind))
    text = lambda name: blank_to_null(quoted(name))
    row_id = F.col("source_row_id")
    return raw.select(
        row_id,
        transaction_id(row_id, quoted("ID"), quoted("Unnamed: 22"), quoted("Unnamed: 23"))
        .alias("source_transaction_id"),
        account_bucket(row_id, accounts).alias("account_id"),
        F.trim("Action").alias("raw_action"),
        quoted("Transaction Date").try_cast("date").alias("transaction_date"),
        clock_time(F.col("Time")).alias("transaction_time"),
        text("Ticker").alias("ticker"),
        text("Name").alias("security_name"),
        amount("No. of shares", SHARES).alias("shares"),
        amount("Price / share", PRICE).alias("price_per_share"),
        text("Currency (Price / share)").alias("currency_price"),
        number_or_null(quoted("Exchange rate"), PRICE).alias("exchange_rate"),
        amount("Result of Sell", MONEY).alias("realized_result"),
        text("Currency (Result)").alias("currency_result"),
        amount("Total (GBP)", MONEY).alias("total_amount"),
        F.coalesce(text("Currency (Total)"), F.lit(fixed.DEFAULT_CURRENCY)).alias("currency_total"),
        amount("Withholding tax", MONEY).alias("withholding_tax"),
        amount("Charge amount", MONEY).alias("charge_amount"),
        amount("Stamp duty reserve tax", MONEY).alias("stamp_duty"),
        F.trim("Notes").alias("notes"),
        invalid_date(quoted("Transaction Date")).alias("flag_invalid_date"),
        invalid_amount(quoted("Total (GBP)")).alias("flag_invalid_amount"),
    )


def action_mapping(spark: SparkSession, rows: list[tuple] = fixed.ACTION_MAPPING) -> DataFrame:
    return literal_frame(spark, rows, [
        ("raw_action", "string"), ("standardized_category", "string"), ("cash_impact_sign", "int"),
        ("security_impact_sign", "int"), ("fee_tax_treatment", "string"), ("needs_review", "int"),
    ])


def _with_sign(staged: DataFrame, mapping: DataFrame, sign: str) -> DataFrame:
    """Rows whose action has a non-zero sign. Unmapped actions drop out here, see ``unmapped_actions``."""
    signs = mapping.where(F.col(sign) != 0).select(match_key(F.col("raw_action")).alias("_action"), sign)
    return staged.withColumn("_action", match_key(F.col("raw_action"))).join(signs, "_action").drop("_action")


def cash_transactions(staged: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every row that moves cash, with its signed impact."""
    amount = F.coalesce("total_amount", F.lit(0).cast(MONEY))
    usable = staged.where("flag_invalid_date = 0 and flag_invalid_amount = 0")
    return _with_sign(usable, mapping, "cash_impact_sign").select(
        "source_row_id", "source_transaction_id", "account_id", "transaction_date", "transaction_time",
        F.col("raw_action").alias("transaction_type"),
        amount.alias("total_amount"),
        "currency_total",
        (amount * F.col("cash_impact_sign")).cast(MONEY).alias("cash_impact"),
        "withholding_tax", "charge_amount", "stamp_duty", "notes",
    )


def security_transactions(staged: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every row that moves shares, with its signed impact. Bad amounts do not matter here."""
    shares = F.coalesce("shares", F.lit(0).cast(SHARES))
    usable = staged.where("flag_invalid_date = 0 and ticker is not null")
    return _with_sign(usable, mapping, "security_impact_sign").select(
        "source_row_id", "source_transaction_id", "account_id", "ticker", "transaction_date", "transaction_time",
        F.col("raw_action").alias("transaction_type"),
        shares.alias("shares"),
        "price_per_share", "currency_price", "exchange_rate",
        (shares * F.col("security_impact_sign")).cast(SHARES).alias("security_impact"),
        "realized_result", "notes",
    )


def new_securities(staged: DataFrame, securities: DataFrame) -> DataFrame:
    """Tickers the master lacks, one name each.

    Pairs are made distinct first: that hashes, while a maximum of text makes every task sort.
    """
    pairs = staged.where("ticker is not null").select("ticker", "security_name").distinct()
    seen = pairs.groupBy("ticker").agg(F.max("security_name").alias("security_name"))
    return seen.join(securities.select("ticker"), "ticker", "left_anti")


def securities_upsert(staged: DataFrame, securities: DataFrame) -> DataFrame:
    return securities.select("ticker", "security_name").unionByName(new_securities(staged, securities))
