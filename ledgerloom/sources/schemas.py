"""Column contracts of the tables the jobs read and write."""

from pyspark.sql import types as T

from ledgerloom.functions.columns import MONEY, PRICE, SHARES

# Header of the raw transaction file, in file order.
RAW_TRANSACTION_COLUMNS = [
    "Action", "Transaction Date", "Time", "Ticker", "Name", "No. of shares", "Price / share",
    "Currency (Price / share)", "Exchange rate", "Result of Sell", "Currency (Result)", "Total (GBP)",
    "Currency (Total)", "Withholding tax", "Currency (Withholding tax)", "Charge amount",
    "Currency (Charge amount)", "Stamp duty reserve tax", "Currency (Stamp duty reserve tax)", "Notes", "ID",
    "Unnamed: 22", "Unnamed: 23", "Unnamed: 24", "Unnamed: 25", "Unnamed: 26", "Unnamed: 27",
]

RAW_TRANSACTIONS = T.StructType([T.StructField(c, T.StringType()) for c in RAW_TRANSACTION_COLUMNS])


def _contract(*fields: tuple[str, str]) -> T.StructType:
    out = T.StructType()
    for name, kind in fields:
        out = out.add(name, kind)
    return out


CASH_TRANSACTIONS = _contract(
    ("transaction_id", "long"), ("source_row_id", "long"), ("source_transaction_id", "string"),
    ("account_id", "long"), ("transaction_date", "date"), ("transaction_time", "string"),
    ("transaction_type", "string"), ("total_amount", MONEY), ("currency_total", "string"),
    ("cash_impact", MONEY), ("withholding_tax", MONEY), ("charge_amount", MONEY), ("stamp_duty", MONEY),
    ("notes", "string"),
)
SECURITY_TRANSACTIONS = _contract(
    ("transaction_id", "long"), ("source_row_id", "long"), ("source_transaction_id", "string"),
    ("account_id", "long"), ("ticker", "string"), ("transaction_date", "date"),
    ("transaction_time", "string"), ("transaction_type", "string"), ("shares", SHARES),
    ("price_per_share", PRICE), ("currency_price", "string"), ("exchange_rate", PRICE),
    ("security_impact", SHARES), ("realized_result", MONEY), ("notes", "string"),
)
RECONCILIATION_BREAKS = _contract(
    ("break_id", "long"), ("account_id", "long"), ("business_date", "date"), ("ticker", "string"),
    ("break_category", "string"), ("internal_value", SHARES), ("custodian_value", SHARES),
    ("variance", SHARES), ("dollar_exposure", MONEY), ("injection_id", "integer"),
)
EXCEPTION_LOG = _contract(
    ("exception_id", "long"), ("break_id", "long"), ("business_date", "date"), ("account_id", "long"),
    ("ticker", "string"), ("break_type", "string"), ("severity", "string"), ("internal_value", SHARES),
    ("custodian_value", SHARES), ("variance_amount", SHARES), ("dollar_exposure", MONEY),
    ("root_cause", "string"), ("owner", "string"), ("status", "string"), ("detected_date", "date"),
    ("due_date", "date"), ("aging_days", "integer"), ("sla_status", "string"), ("resolution_notes", "string"),
    ("evidence_file", "string"),
)
ANOMALY_FLAGS = _contract(
    ("account_id", "long"), ("transaction_id", "long"), ("transaction_date", "string"),
    ("anomaly_type", "string"), ("amount", "decimal(38,2)"), ("balance", "decimal(38,2)"),
    ("threshold_value", "double"), ("severity", "string"), ("reason_code", "string"),
    ("review_action", "string"), ("source_file", "string"),
)
