"""The whole rebuild as one chain of layers, on the driver tables.

orders stand in for cash transactions, lineitem for trades, events for the raw transaction file and
for the vendor file registry. The custodian's books are our own plus dated adjustments, one row
taken out and one row put in.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import MONEY, PRICE, SHARES, literal_frame, lookup, quoted
from ledgerloom.operators import checks, exceptions, files, ledger, recon, staging
from ledgerloom.sources.schemas import RAW_TRANSACTION_COLUMNS
from ledgerloom.sources.workspace import Workspace

# Fixed values of the stand-in data.
ACTIONS = [
    ("1-URGENT", "Deposit", 1, 0, "N/A", 0),
    ("2-HIGH", "Withdrawal", -1, 0, "N/A", 0),
    ("3-MEDIUM", "Interest", 1, 0, "N/A", 0),
    ("4-NOT SPECIFIED", "Adjustment", 0, 0, "N/A", 1),
    ("N", "Market Buy", -1, 1, "Include in net cash impact", 0),
    ("R", "Market Sell", 1, -1, "Include in net cash impact", 0),
    ("A", "Adjustment", 0, 0, "N/A", 1),
]
EVENT_ACTIONS = {"view": "Deposit", "click": "Market buy", "error": "Withdrawal", "purchase": "Market sell",
                 "signup": "Card top up"}
ADJUSTMENTS = [
    # id, type, table, account, date, ticker, cash, shares, detection rule, carried forward
    (0, "Missing Cash Record", "custodian_balances", 1, "1997-01-04", None, "-1000.00", None,
     "Cash Balance Variance", True),
    (1, "Fee Mismatch", "custodian_balances", 2, "1997-02-15", None, "-2.50", None, "Small Cash Variance", True),
    (2, "Timing Difference", "custodian_balances", 3, "1997-03-10", None, "-500.00", None, "Timing Break", False),
    (3, "Share Mismatch", "custodian_positions", 4, "1997-06-01", "T4", None, "10", "Security Position Break", True),
    (4, "Duplicate Cash Record", "custodian_balances", 5, "1997-08-20", None, "250.00", None,
     "Unexplained Cash Variance", True),
    (5, "Missing Vendor File", "vendor_files", None, "1999-09-01", None, None, None, "File Completeness Control", False),
    (6, "Dividend Mismatch", "custodian_balances", 6, "1998-01-15", None, "-15.50", None, "Income Variance", True),
    (7, "Wrong Account Posting", "custodian_positions", 7, "1998-05-05", None, None, None,
     "Offsetting Security Break across accounts", False),
]
# Accounts whose first transaction is missed, booked twice, or booked twice a day late: (account, id, sign, days).
FIRST_TRANSACTION_FAULTS = [(9, 8, -1, 0), (10, 9, 1, 0), (11, 10, 1, 1)]
MISPOSTING = dict(injection_id=7, day="1998-05-05", ticker="T7", shares="50", right_account=7, wrong_account=999)
MISSING_ROW = (8, "1999-06-01")
STRAY_ROW = (999, "1999-06-01", "50", 7)
MISSING_POSITION_FILE = "1999-09-01"
REVIEW_DATE = "2001-07-30"
RECLASSIFIED_TICKER = "T4"
LARGE_MOVEMENT = 400_000
EXCESS_CASH = 15_000_000
Z_SCORE = 2.0
# Transactions that come in late: some of those from the first day on, all of those from the second.
LATE_FROM, LATE_ALL = "1998-05-20", "2001-06-25"
LEDGER_DAYS = ("1998-05-20", "1998-07-04")


class Pipeline:
    """Layers over one data folder. Shared layers are written once per pipeline."""

    def __init__(self, spark: SparkSession, folder: str, workspace: Workspace | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.workspace = workspace or Workspace(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Inputs

    def raw(self) -> DataFrame:
        """Dirty raw transactions as text, one per event."""
        n = F.col("event_id")
        every = lambda k: n % k == 0
        value = F.col("value").cast("decimal(19,2)").cast("string")
        signed = F.when(every(3), F.concat(F.lit("-"), value)).otherwise(value)
        code = F.concat(F.lit("E"), n.cast("string"))
        action = lookup(F.col("event_type"), EVENT_ACTIONS, F.lit(None).cast("string"))
        gbp = F.when(every(5), "  ").when(every(4), F.lit(None)).otherwise(" GBP ")
        columns = {
            "Action": F.when(every(43), F.lit(None)).when(every(29), F.upper(action))
            .otherwise(F.concat(F.lit("  "), action, F.lit(" "))),
            "Transaction Date": F.when(every(13), "not-a-date").when(every(17), F.lit(None))
            .otherwise(F.col("ts").cast("date").cast("string")),
            "Time": F.when(every(41), "xx").when(every(5), F.lit(None)).otherwise(F.date_format("ts", "HH:mm:ss")),
            "Ticker": F.when(every(10), "   ").otherwise(F.concat(F.lit("T"), (F.col("user_id") % 8).cast("string"))),
            "Name": F.concat(F.lit(" Name "), (F.col("user_id") % 16).cast("string"), F.lit(" ")),
            "No. of shares": signed,
            "Price / share": F.when(every(6), F.lit(None)).otherwise(value),
            "Currency (Price / share)": gbp,
            "Exchange rate": F.when(every(19), "Not available").otherwise(value),
            "Result of Sell": F.when(every(9), signed),
            "Currency (Result)": gbp,
            "Total (GBP)": F.when(every(19), "Not available").when(every(23), "abc").otherwise(signed),
            "Currency (Total)": gbp,
            "Withholding tax": F.when(every(8), value),
            "Notes": F.when(every(14), F.concat(F.lit(" note "), value)),
            "ID": F.when(every(11), F.lit(None)).when(every(7), "  ").otherwise(code),
            "Unnamed: 22": F.when(every(7) & every(2), F.concat(F.lit(" U22-"), code, F.lit(" "))),
            "Unnamed: 23": F.when(every(11) & every(3), F.concat(F.lit("U23-"), code)).otherwise(""),
        }
        none = F.lit(None).cast("string")
        return self.table("events").select(
            n.alias("source_row_id"), *[columns.get(c, none).cast("string").alias(c) for c in RAW_TRANSACTION_COLUMNS])

    def loaded_twice(self) -> DataFrame:
        """Raw rows as loaded twice in part: large trades come again."""
        rows = self.raw()
        return rows.unionByName(rows.where(quoted("No. of shares").try_cast("double") > 100))

    def raw_with_copies(self) -> DataFrame:
        return self.loaded_twice().drop("source_row_id")

    def staged(self) -> DataFrame:
        return staging.stage_clean(self.raw())

    def registry(self) -> DataFrame:
        """Vendor file registry, one file per event."""
        n = F.col("event_id")
        kind = F.concat(F.lit("F_"), F.upper("event_type"))
        part = F.when(F.col("user_id") % 3 == 0, "").otherwise(F.concat(F.lit("_"), (F.col("user_id") % 3).cast("string")))
        return self.table("events").select(
            n.alias("source_file_id"),
            F.concat(kind, F.lit("_"), F.date_format("ts", "yyyyMMdd"), part, F.lit(".csv")).alias("file_name"),
            F.lit("Custodian_Bank").alias("source_system"),
            F.col("ts").cast("date").alias("expected_date"),
            F.when(n % 31 == 0, " missing ").otherwise("RECEIVED").alias("receipt_status"),
            F.when(n % 29 != 0, F.col("ts")).alias("received_timestamp"),
            F.when(n % 37 == 0, "FAILED").when(n % 41 == 0, "on hold").otherwise("VALIDATED").alias("validation_status"),
            F.floor(F.col("value") * 4).cast("bigint").alias("record_count"),
            F.col("value").cast(SHARES).alias("control_total"))

    def actions(self) -> DataFrame:
        return staging.action_mapping(self.spark, ACTIONS)

    def accounts(self) -> DataFrame:
        account = F.col("c_custkey") % 50 + 1
        return self.table("customer").select(account.alias("account_id")).distinct().withColumn(
            "account_type", F.when(F.col("account_id") % 2 == 1, "Investment Account").otherwise("Trading Account"))

    def wealthy_accounts(self) -> DataFrame:
        """Accounts with a customer above 9000, which leaves some accounts unknown."""
        rich = self.table("customer").where("c_acctbal > 9000")
        return rich.select((F.col("c_custkey") % 50 + 1).alias("account_id")).distinct()

    def securities(self) -> DataFrame:
        """Security master; it lacks the last ticker that is traded."""
        ticker = F.concat(F.lit("T"), (F.col("p_partkey") % 7).cast("string"))
        return self.table("part").groupBy(ticker.alias("ticker")).agg(F.max("p_name").alias("security_name"))

    def staged_orders(self, account: Column | None = None) -> DataFrame:
        none = lambda kind: F.lit(None).cast(kind)
        if account is None:
            account = F.col("o_custkey") % 50 + 1
        return self.table("orders").select(
            F.col("o_orderkey").alias("source_row_id"),
            F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("source_transaction_id"),
            account.alias("account_id"), F.col("o_orderpriority").alias("raw_action"),
            F.col("o_orderdate").cast("date").alias("transaction_date"), F.lit("00:00:00").alias("transaction_time"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"), F.lit("GBP").alias("currency_total"),
            none(MONEY).alias("withholding_tax"), none(MONEY).alias("charge_amount"), none(MONEY).alias("stamp_duty"),
            none("string").alias("notes"), F.lit(0).alias("flag_invalid_date"), F.lit(0).alias("flag_invalid_amount"))

    def staged_lines(self) -> DataFrame:
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return self.table("lineitem").select(
            number.alias("source_row_id"), F.concat(F.lit("L"), number.cast("string")).alias("source_transaction_id"),
            (F.col("l_suppkey") % 50 + 1).alias("account_id"),
            F.concat(F.lit("T"), (F.col("l_partkey") % 8).cast("string")).alias("ticker"),
            F.col("l_returnflag").alias("raw_action"), F.col("l_shipdate").cast("date").alias("transaction_date"),
            F.lit("00:00:00").alias("transaction_time"), F.col("l_quantity").cast(SHARES).alias("shares"),
            (F.col("l_extendedprice") / F.col("l_quantity")).cast(PRICE).alias("price_per_share"),
            F.lit("GBP").alias("currency_price"), F.lit(None).cast(PRICE).alias("exchange_rate"),
            F.lit(None).cast(MONEY).alias("realized_result"), F.lit(None).cast("string").alias("notes"),
            F.lit(0).alias("flag_invalid_date"), F.lit(0).alias("flag_invalid_amount"))

    def cash(self) -> DataFrame:
        rows = staging.cash_transactions(self.staged_orders(), self.actions())
        return rows.withColumn("transaction_id", F.col("source_row_id"))

    def trades(self) -> DataFrame:
        rows = staging.security_transactions(self.staged_lines(), self.actions())
        return rows.withColumn("transaction_id", F.col("source_row_id"))

    def adjustments(self) -> DataFrame:
        """Log of the known faults, those sized by the data included."""
        kinds = [("injection_id", "int"), ("exception_type", "string"), ("affected_table", "string"),
                 ("account_id", "bigint"), ("affected_date", "date"), ("ticker", "string"), ("impact_amount", MONEY),
                 ("impact_shares", SHARES), ("expected_detection_rule", "string"), ("carry_forward", "boolean")]
        listed = literal_frame(self.spark, ADJUSTMENTS, kinds)
        faults = literal_frame(self.spark, FIRST_TRANSACTION_FAULTS, [
            ("account_id", "bigint"), ("injection_id", "int"), ("sign", "int"), ("days", "int")])
        first = self.cash().groupBy("account_id").agg(F.min_by(
            F.struct("transaction_date", "cash_impact"), F.struct("transaction_date", "transaction_id")).alias("t"))
        sized = first.join(F.broadcast(faults), "account_id").select(
            "injection_id", F.lit("First Transaction Fault").alias("exception_type"),
            F.lit("custodian_balances").alias("affected_table"), "account_id",
            F.date_add("t.transaction_date", F.col("days")).alias("affected_date"),
            F.lit(None).cast("string").alias("ticker"),
            (F.col("t.cash_impact") * F.col("sign")).cast(MONEY).alias("impact_amount"),
            F.lit(None).cast(SHARES).alias("impact_shares"),
            F.lit("Transaction Match").alias("expected_detection_rule"), F.lit(False).alias("carry_forward"))
        return self.workspace.layer("adjustments", lambda: listed.unionByName(sized))

    # Books

    def _by_month(self, name: str, date_column: str, keys: list[str], build) -> DataFrame:
        """A layer with its ``month``, bucketed by the keys and the month: books that are compared lie alike."""
        return self.workspace.memo(name, lambda: self.workspace.write_bucketed(
            ledger.with_month(build(), date_column), name, [*keys, "month"]))

    def ledger_by_month(self) -> DataFrame:
        return self._by_month("ledger", "ledger_date", ["account_id"], lambda: ledger.ledger_balances(self.cash(), self.accounts()))

    def ledger(self) -> DataFrame:
        return self.ledger_by_month().drop("month")

    def openings(self) -> DataFrame:
        return self.workspace.memo("openings", lambda: self.workspace.write_bucketed(
            ledger.month_openings(self.ledger_by_month()), "openings", ["account_id", "month"]))

    def moves(self) -> DataFrame:
        return self._by_month("moves", "transaction_date", ["account_id"], lambda: ledger.daily_net_cash(self.cash()))

    def dented_ledger(self) -> DataFrame:
        """Ledger with one balance off by 1 and one day missing, for the roll-forward checks."""
        day = F.lit("1998-03-03").cast("date")
        hit = (F.col("account_id") == 5) & (F.col("ledger_date") == day)
        gone = (F.col("account_id") == 6) & (F.col("ledger_date") == day)
        bumped = F.when(hit, F.col("cash_balance") + 1).otherwise(F.col("cash_balance")).cast(MONEY)
        return self.ledger_by_month().where(~gone).withColumn("cash_balance", bumped)

    def positions_by_month(self) -> DataFrame:
        return self._by_month("positions", "position_date", ["account_id", "ticker"], lambda: ledger.positions(self.trades()))

    def positions(self) -> DataFrame:
        return self.positions_by_month().drop("month")

    def baseline_balances(self) -> DataFrame:
        rows = self.ledger().select("account_id", F.col("ledger_date").alias("balance_date"),
                                    F.col("cash_balance").alias("custodian_cash_balance"))
        return files.file_link(rows, self.expected_files(), "balance_date", fixed.BALANCE_FILE_PREFIX)

    def baseline_positions(self) -> DataFrame:
        rows = self.positions().select("account_id", "ticker", "position_date",
                                       F.col("share_quantity").alias("custodian_share_quantity"))
        return files.file_link(rows, self.expected_files(), "position_date", fixed.POSITION_FILE_PREFIX)

    def expected_files(self) -> DataFrame:
        return self.workspace.layer("expected-files", lambda: files.file_manifest(self.ledger(), self.positions()))

    def manifest(self) -> DataFrame:
        """Expected files with the totals of the books as first received, one file missing."""
        def build():
            cash = files.file_control_totals(self.baseline_balances(), self.expected_files(),
                                             "custodian_cash_balance", fixed.BALANCE_FILE_PREFIX)
            both = files.file_control_totals(self.baseline_positions(), cash, "custodian_share_quantity",
                                             fixed.POSITION_FILE_PREFIX)
            return files.mark_missing_file(both, MISSING_POSITION_FILE, fixed.POSITION_FILE_PREFIX)
        return self.workspace.layer("manifest", build)

    def cash_deltas(self) -> DataFrame:
        return self.adjustments().where("affected_table = 'custodian_balances'").select(
            "injection_id", "account_id", F.col("affected_date").alias("effective_date"),
            F.col("impact_amount").cast(SHARES).alias("delta"), "carry_forward")

    def share_deltas(self) -> DataFrame:
        return self.adjustments().where("impact_shares is not null").select(
            "injection_id", "account_id", "ticker", F.col("affected_date").alias("effective_date"),
            F.col("impact_shares").alias("delta"), "carry_forward")

    def adjusted_balances(self) -> DataFrame:
        return files.apply_adjustments(self.baseline_balances(), self.cash_deltas(), ["account_id"], "balance_date",
                                       "custodian_cash_balance")

    def custodian_balances(self) -> DataFrame:
        return self.custodian_balances_by_month().drop("month")

    def custodian_balances_by_month(self) -> DataFrame:
        def build():
            lost = (F.col("account_id") == MISSING_ROW[0]) & (F.col("balance_date") == F.lit(MISSING_ROW[1]).cast("date"))
            rows = self.adjusted_balances().where(~lost)
            stray = self.spark.range(1).select(
                F.lit(STRAY_ROW[1]).cast("date").alias("balance_date"), F.lit(STRAY_ROW[0]).cast("bigint").alias("account_id"),
                F.lit(None).cast("bigint").alias("source_file_id"), F.lit("INJECTED").alias("simulation_flag"),
                F.lit(STRAY_ROW[2]).cast(MONEY).alias("custodian_cash_balance"),
                F.lit(STRAY_ROW[3]).cast("int").alias("injection_id"))
            day_number = F.date_diff("balance_date", F.lit("1990-01-01").cast("date"))
            return rows.unionByName(stray).select(
                (F.col("account_id") * 100_000 + day_number).cast("bigint").alias("custodian_balance_id"), "*",
                F.lit("GBP").alias("currency"))
        return self._by_month("custodian-balances", "balance_date", ["account_id"], build)

    def custodian_positions(self) -> DataFrame:
        return self.custodian_positions_by_month().drop("month")

    def custodian_positions_by_month(self) -> DataFrame:
        def build():
            adjusted = files.apply_adjustments(self.baseline_positions(), self.share_deltas(), ["account_id", "ticker"],
                                               "position_date", "custodian_share_quantity")
            return files.apply_misposting(adjusted, **MISPOSTING)
        return self._by_month("custodian-positions", "position_date", ["account_id", "ticker"], build)

    # Reconciliation

    def cash_comparison(self) -> DataFrame:
        return recon.cash_recon(self.ledger_by_month(), self.custodian_balances_by_month())

    def position_comparison(self) -> DataFrame:
        return recon.position_recon(self.positions_by_month(), self.custodian_positions_by_month())

    def open_cash(self) -> DataFrame:
        """Cash rows that disagree: few, and all that the later steps read of the comparison."""
        return self.workspace.layer("open-cash", lambda: self.cash_comparison().where("break_type <> 'MATCHED'"))

    def open_positions(self) -> DataFrame:
        return self.workspace.layer("open-positions", lambda: self.position_comparison().where("break_type <> 'MATCHED'"))

    def matches(self) -> DataFrame:
        return self.workspace.layer("matches", lambda: recon.transaction_match(self.open_cash(), self.cash()))

    def breaks(self) -> DataFrame:
        return self.workspace.memo("breaks", lambda: recon.recon_breaks(
            self.open_cash(), self.open_positions(), self.workspace))

    def log(self) -> DataFrame:
        return self.workspace.memo("log", lambda: exceptions.complete_log(
            self.breaks(), self.matches(), self.adjustments(), self.workspace, REVIEW_DATE, RECLASSIFIED_TICKER))

    def expected_counts(self) -> DataFrame:
        """What the eight layers should count, from their sources and the faults put in."""
        lost = literal_frame(self.spark, [MISSING_ROW], [("account_id", "bigint"), ("day", "date")])
        stray = literal_frame(self.spark, [STRAY_ROW[:2]], [("account_id", "bigint"), ("day", "date")])
        # the misposted row borrows its other fields from a position of its day
        posted = self.positions().where(F.col("position_date") == F.lit(MISPOSTING["day"]).cast("date")).select("account_id").limit(1)
        books = lambda df, day, value, *more: df.select("account_id", *more, day, value)
        return checks.expected_counts(
            self.spark.range(1).drop("id"), self.staged_orders(), self.staged_lines(), self.actions(), self.accounts(),
            ledger.daily_net_shares(self.trades()), lost, stray, posted,
            (books(self.ledger(), "ledger_date", "cash_balance"), books(self.custodian_balances(), "balance_date", "custodian_cash_balance")),
            (books(self.positions(), "position_date", "share_quantity", "ticker"),
             books(self.custodian_positions(), "position_date", "custodian_share_quantity", "ticker")),
            self.breaks(), self.matches(), self.adjustments())
