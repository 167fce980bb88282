"""Two-sided comparison of books, and transaction-level causes of the differences."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import MONEY, SHARES, money
from ledgerloom.operators.ids import ordered_id
from ledgerloom.sources.workspace import Workspace


def compare_books(internal: DataFrame, custodian: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of (keys, internal_value) with (keys, custodian_value, injection_id).

    A full outer join cannot split a hot key, so it runs as two joins that can: every custodian
    row looks up its internal row, and internal rows whose key the custodian lacks are added.
    Internal rows with an empty key match nothing and are added as they are, so both joins read
    the same internal rows and share one shuffle of them. No explicit repartition: joins on top of
    one are never split.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    keyed = internal.where(complete)
    both = custodian.withColumnRenamed("custodian_value", "_custodian").join(keyed, keys, "left").select(
        *keys, "internal_value", F.col("_custodian").alias("custodian_value"), "injection_id")
    seen = custodian.select(*keys).distinct().withColumn("_seen", F.lit(True))
    # Not an anti join: that one would be moved below the projection and shuffle the side again.
    alone = keyed.join(seen, keys, "left").where("_seen is null").drop("_seen")
    unmatched = alone.unionByName(internal.where(~complete))
    return both.unionByName(unmatched.select(
        *keys, "internal_value",
        F.lit(None).cast(custodian.schema["custodian_value"].dataType).alias("custodian_value"),
        F.lit(None).cast(custodian.schema["injection_id"].dataType).alias("injection_id")))


def _difference(kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    return (F.coalesce("internal_value", zero) - F.coalesce("custodian_value", zero)).cast(kind)


def _break_type(variance: Column, tolerance: str, label: str) -> Column:
    # Nested rather than chained: for the one-sided rows the planner then sees that they never match.
    sized = F.when(F.abs(variance) > money(tolerance), label).otherwise("MATCHED")
    present = F.when(F.col("custodian_value").isNull(), "MISSING_IN_CUSTODIAN").otherwise(sized)
    return F.when(F.col("internal_value").isNull(), "MISSING_IN_INTERNAL").otherwise(present)


def _injection(custodian: DataFrame) -> Column:
    """Id of the known fault behind a custodian row; books without that column have none."""
    if "injection_id" in custodian.columns:
        return F.col("injection_id")
    return F.lit(None).cast("int").alias("injection_id")


def _month(internal: DataFrame, custodian: DataFrame) -> list[str]:
    """``month`` as one more key where both books carry it: the day implies it, and books bucketed by it join where they lie."""
    return ["month"] if "month" in internal.columns and "month" in custodian.columns else []


def _cash_sides(ledger: DataFrame, custodian: DataFrame) -> DataFrame:
    month = _month(ledger, custodian)
    return compare_books(
        ledger.select("account_id", *month, F.col("ledger_date").alias("business_date"),
                      F.col("cash_balance").alias("internal_value")),
        custodian.select("account_id", *month, F.col("balance_date").alias("business_date"),
                         F.col("custodian_cash_balance").alias("custodian_value"), _injection(custodian)),
        ["account_id", *month, "business_date"])


def _position_sides(positions: DataFrame, custodian: DataFrame) -> DataFrame:
    month = _month(positions, custodian)
    return compare_books(
        positions.select("account_id", *month, F.col("position_date").alias("business_date"), "ticker",
                         F.col("share_quantity").alias("internal_value")),
        custodian.select("account_id", *month, F.col("position_date").alias("business_date"), "ticker",
                         F.col("custodian_share_quantity").alias("custodian_value"), _injection(custodian)),
        ["account_id", *month, "business_date", "ticker"])


def cash_recon(ledger: DataFrame, custodian: DataFrame, tolerance: str = fixed.CASH_TOLERANCE) -> DataFrame:
    """Every account-day of either side with its variance and break type."""
    variance = _difference(MONEY)
    return _cash_sides(ledger, custodian).select(
        "account_id", "business_date", F.col("internal_value").alias("internal_cash"),
        F.col("custodian_value").alias("custodian_cash"), variance.alias("cash_variance"),
        _break_type(variance, tolerance, "CASH_BALANCE_BREAK").alias("break_type"), "injection_id")


def position_recon(positions: DataFrame, custodian: DataFrame,
                   tolerance: str = fixed.SHARE_TOLERANCE) -> DataFrame:
    """Every account-day-ticker of either side with its variance and break type."""
    variance = _difference(SHARES)
    return _position_sides(positions, custodian).select(
        "account_id", "business_date", "ticker", F.col("internal_value").alias("internal_shares"),
        F.col("custodian_value").alias("custodian_shares"), variance.alias("share_variance"),
        _break_type(variance, tolerance, "SHARE_QUANTITY_BREAK").alias("break_type"), "injection_id")


def _totals(sides: DataFrame, scale: int, tolerance: str, noun: str, kind: str) -> DataFrame:
    rounded = sides.withColumn("variance", F.round(_difference(kind), scale))
    off = rounded.where((F.abs("variance") > money(tolerance))
                        | F.col("internal_value").isNull() | F.col("custodian_value").isNull())
    measure = noun if noun == "cash" else "share"
    return off.agg(
        F.count("*").alias(f"{noun}_break_count"),
        F.sum(F.abs("variance")).alias(f"total_absolute_{measure}_variance"),
        F.sum("variance").alias(f"net_{measure}_variance"))


def cash_recon_totals(ledger: DataFrame, custodian: DataFrame, tolerance: str = fixed.CASH_TOLERANCE) -> DataFrame:
    return _totals(_cash_sides(ledger, custodian), 2, tolerance, "cash", MONEY)


def position_recon_totals(positions: DataFrame, custodian: DataFrame,
                          tolerance: str = fixed.SHARE_TOTALS_TOLERANCE) -> DataFrame:
    return _totals(_position_sides(positions, custodian), 8, tolerance, "position", SHARES)


def recon_review(ledger: DataFrame, custodian: DataFrame, tolerance: str = fixed.CASH_TOLERANCE) -> DataFrame:
    """Side-by-side review sheet; a missing side counts as zero, as an empty cell does."""
    sides = _cash_sides(ledger, custodian)
    both = lambda side, column: F.when(F.col(side).isNotNull(), F.col(column))
    variance = F.round(_difference(MONEY), 2)
    return sides.select(
        both("internal_value", "account_id").alias("account_id_int"),
        both("internal_value", "business_date").alias("ledger_date"),
        F.col("internal_value").alias("cash_balance"),
        both("custodian_value", "account_id").alias("account_id_cust"),
        both("custodian_value", "business_date").alias("balance_date"),
        F.col("custodian_value").alias("custodian_cash_balance"),
        variance.alias("variance"),
        F.when(F.abs(variance) > money(tolerance), "Break").otherwise("Pass").alias("pass_fail"))


def _open_breaks(cash_comparison: DataFrame) -> DataFrame:
    """Distinct (account, day, variance) of the cash breaks: copies of a break match alike."""
    return (cash_comparison.where("break_type <> 'MATCHED'")
            .select("account_id", "business_date", "cash_variance").distinct())


def _matches(breaks: DataFrame, cash: DataFrame, first_day_back: int, last_day_back: int) -> DataFrame:
    """Transactions whose size equals a break's, 0 or more days before it.

    Every candidate day is written out as a key of its own, and size is a key too, so the join is
    an equality on account, day and size and yields true matches only, never all pairs of a group.
    """
    wanted = breaks.select(
        "*", F.abs("cash_variance").alias("size"),
        F.explode(F.sequence(F.lit(first_day_back), F.lit(last_day_back))).alias("days_back"),
    ).select("*", F.date_sub("business_date", F.col("days_back")).alias("transaction_date"))
    moves = cash.select("account_id", "transaction_date", F.abs("cash_impact").alias("size"),
                        "transaction_id", "cash_impact")
    same = F.col("cash_variance") == F.col("cash_impact")
    opposite = F.col("cash_variance") == -F.col("cash_impact")
    cause = (
        F.when((F.col("days_back") == 0) & same, "MISSING_IN_CUSTODIAN")
        .when((F.col("days_back") == 0) & opposite, "DUPLICATE_TRANSACTION")
        .when((F.col("days_back") > 0) & opposite, "TIMING_DIFFERENCE")
    )
    return (
        wanted.join(moves, ["account_id", "transaction_date", "size"])
        .select("account_id", "business_date", "cash_variance", "transaction_id",
                cause.alias("inferred_root_cause"))
        .where("inferred_root_cause is not null")
    )


def same_day_match(cash_comparison: DataFrame, cash: DataFrame) -> DataFrame:
    """Breaks explained by a transaction of the day: missed by the custodian, or booked twice."""
    return _matches(_open_breaks(cash_comparison), cash, 0, 0)


def timing_match(cash_comparison: DataFrame, cash: DataFrame, days: int = 3) -> DataFrame:
    """Breaks that undo a transaction of the last few days."""
    return _matches(_open_breaks(cash_comparison), cash, 1, days)


def transaction_match(cash_comparison: DataFrame, cash: DataFrame, days: int = 3) -> DataFrame:
    """Both kinds of match in one join, without repeats."""
    return _matches(_open_breaks(cash_comparison), cash, 0, days).distinct()


def recon_breaks(cash_comparison: DataFrame, position_comparison: DataFrame, workspace: Workspace,
                 share_price: str = fixed.SHARE_PRICE_PROXY, start: int = 0) -> DataFrame:
    """Cash breaks, then share breaks, with consecutive break ids in a total order."""
    cash = cash_comparison.where("break_type <> 'MATCHED'").select(
        F.lit(0).alias("_book"), "account_id", "business_date", F.lit(None).cast("string").alias("ticker"),
        F.col("break_type").alias("break_category"), F.col("internal_cash").cast(SHARES).alias("internal_value"),
        F.col("custodian_cash").cast(SHARES).alias("custodian_value"),
        F.col("cash_variance").cast(SHARES).alias("variance"),
        F.abs("cash_variance").cast(MONEY).alias("dollar_exposure"), "injection_id")
    shares = position_comparison.where("break_type <> 'MATCHED'").select(
        F.lit(1).alias("_book"), "account_id", "business_date", "ticker",
        F.col("break_type").alias("break_category"), F.col("internal_shares").alias("internal_value"),
        F.col("custodian_shares").alias("custodian_value"), F.col("share_variance").alias("variance"),
        (F.abs("share_variance") * F.lit(share_price).cast("decimal(9,2)")).cast(MONEY).alias("dollar_exposure"),
        "injection_id")
    order = ["_book", "account_id", "business_date", "ticker", "internal_value", "custodian_value", "injection_id"]
    return ordered_id(cash.unionByName(shares), order, "break_id", workspace, start).drop("_book")
