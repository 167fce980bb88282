"""Labels, texts, codes and thresholds whose exact content decides a result.

Nothing here is logic. Operators take most of these as parameter defaults.
"""

# Raw action -> category, cash sign, security sign, fee treatment, needs review.
ACTION_MAPPING = [
    ("Deposit", "Deposit", 1, 0, "Separate if fee present", 0),
    ("Withdrawal", "Withdrawal", -1, 0, "Separate if fee present", 0),
    ("Market buy", "Market Buy", -1, 1, "Include in net cash impact", 0),
    ("Market sell", "Market Sell", 1, -1, "Include in net cash impact", 0),
    ("Interest on cash", "Interest", 1, 0, "N/A", 0),
    ("Dividend (Ordinary)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
    ("Dividend (Dividend)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
    ("Dividend (Bonus)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
    ("Dividend (Dividends paid by us corporations)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
    ("Dividend (Return of capital non us)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
    ("Dividend (Demerger)", "Adjustment", 0, 0, "N/A", 1),
    ("Dividend (Ordinary manufactured payment)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
    ("Dividend (Dividends paid by foreign corporations)", "Dividend", 1, 0, "Gross up for withholding tax", 0),
]

SYNTHETIC_ACCOUNTS = 50
GENERATED_ID_PREFIX = "GEN-"
UNAVAILABLE_TEXT = "Not available"
DEFAULT_CURRENCY = "GBP"
DEFAULT_TIME = "00:00:00"


# Tolerances, one per check.
CASH_TOLERANCE = "0.01"
SHARE_TOLERANCE = "0.000001"
ROLLFORWARD_TOLERANCE = "0.001"
LAG_TIEOUT_TOLERANCE = "0.01"
SHARE_TOTALS_TOLERANCE = "0.00000001"

# Vendor files.
BALANCE_FILE_PREFIX = "CUST_BAL_"
POSITION_FILE_PREFIX = "CUST_POS_"
SOURCE_SYSTEM = "Custodian_Bank"
RECEIPT_HOUR = 6
LATENESS_HOURS = 4
MIN_RECORD_COUNT = 10
MAX_RECORD_COUNT = 1500

# Reconciliation.
REVIEW_DATE = "2024-07-05"
SHARE_PRICE_PROXY = "150.00"
SEVERITY_LADDER = [(5000, "CRITICAL"), (500, "HIGH"), (50, "MEDIUM")]
SEVERITY_FLOOR = "LOW"
PLANNED_INJECTIONS = 8

# Break category -> owning team; everything else goes to the default owner.
OWNERS = {
    "CASH_BALANCE_BREAK": "Reconciliation Team",
    "SHARE_QUANTITY_BREAK": "Corporate Actions",
    "MISSING_IN_CUSTODIAN": "Custodian Ops",
    "MISSING_VENDOR_FILE": "Custodian Ops",
    "WRONG_ACCOUNT_POSTING": "Custodian Ops",
}
DEFAULT_OWNER = "Control Owner"

# Cash break size bands -> cause: (low, high, low inclusive, high inclusive, cause), first hit wins.
CASH_CAUSE_BANDS = [
    (None, "5", False, False, "FEE_MISMATCH"),
    (None, "20", False, False, "DIVIDEND_MISMATCH"),
    ("240", "260", True, True, "DUPLICATE_CUSTODIAN_CASH_RECORD"),
    ("490", "510", True, True, "SETTLEMENT_TIMING_DIFFERENCE"),
    (None, None, False, False, "CONTROLLED_CASH_EXCEPTION_CARRYFORWARD"),
]
# Other break categories -> cause.
CATEGORY_CAUSES = {
    "SHARE_QUANTITY_BREAK": "CORPORATE_ACTION_OR_TRADE_BREAK",
    "MISSING_VENDOR_FILE": "MISSING_VENDOR_FILE",
    "WRONG_ACCOUNT_POSTING": "WRONG_ACCOUNT_POSTING",
    "MISSING_IN_CUSTODIAN": "MISSING_VENDOR_FILE",
}
DEFAULT_CAUSE = "UNEXPLAINED_VARIANCE"
OVERSTATED_TICKER = "AAPL"
OVERSTATED_TICKER_CAUSE = "CONTROLLED_AAPL_POSITION_OVERSTATEMENT"

# Status by the last digit of the break id: (digits below this, status, note).
STATUS_CYCLE = 10
STATUS_STEPS = [
    (2, "OPEN", "Requires investigation"),
    (4, "IN_REVIEW", "Under review by operations analyst"),
    (5, "PENDING_VENDOR", "Awaiting custodian response"),
    (10, "RESOLVED", "Resolved - variance explained and cleared"),
]
OPEN_STATUSES = ["OPEN", "IN_REVIEW", "PENDING_VENDOR"]
ALL_STATUSES = ["OPEN", "IN_REVIEW", "PENDING_VENDOR", "RESOLVED"]
SLA_DAYS = 2
CONTROL_SLA_DAYS = 1

# Root cause -> where a reviewer finds the evidence.
EVIDENCE = {
    "CONTROLLED_CASH_EXCEPTION_CARRYFORWARD": "cash reconciliation; recon review; adjustment log",
    "FEE_MISMATCH": "cash reconciliation; cash transactions; exception log",
    "DIVIDEND_MISMATCH": "cash reconciliation; cash transactions; adjustment log",
    "CONTROLLED_AAPL_POSITION_OVERSTATEMENT": "position reconciliation; recon review; custodian positions",
    "MISSING_VENDOR_FILE": "vendor files with receipt status MISSING; adjustment log",
    "WRONG_ACCOUNT_POSTING": "position reconciliation; custodian positions; adjustment log",
    "SETTLEMENT_TIMING_DIFFERENCE": "cash reconciliation; recon review; adjustment log",
    "DUPLICATE_CUSTODIAN_CASH_RECORD": "cash reconciliation; custodian balances; adjustment log",
}
DEFAULT_EVIDENCE = "exception detection; reconciliation breaks"

# Control-level exceptions: adjustment type -> (cause, resolution note).
CONTROL_EXCEPTIONS = {
    "Missing Vendor File": ("MISSING_VENDOR_FILE", "Vendor file re-requested and received; gap resolved"),
    "Wrong Account Posting": ("WRONG_ACCOUNT_POSTING", "Custodian corrected account mapping; position reallocated"),
}
CONTROL_OWNER = "Custodian Ops"

# Exposure report rows: (metric, definition).
EXPOSURE_ROWS = [
    ("Source-level injected exposure",
     "Original simulated error amount or share impact from the exception injection log"),
    ("Daily detected exposure", "Exposure on a specific account/date/ticker break record"),
    ("Cumulative detected exposure", "Sum of all detected daily break exposures across the test period"),
    ("Current open exposure",
     "Unresolved exposure as of the simulated review date, deduplicated to current affected positions/balances"),
]

AGING_BUCKETS = [(2, "0-2 days"), (5, "3-5 days"), (10, "6-10 days")]
AGING_BUCKET_LAST = "10+ days"

# Control list: (id, name, process area, frequency, owner, text when failing).
CONTROLS = [
    ("CTRL-01", "Daily Cash Reconciliation", "Reconciliation", "Daily", "FinOps Team", "FAIL (Breaks Detected)"),
    ("CTRL-02", "Daily Position Reconciliation", "Reconciliation", "Daily", "FinOps Team", "FAIL (Breaks Detected)"),
    ("CTRL-03", "Exception SLA Monitoring", "Exception Mgmt", "Daily", "Recon Manager", "FAIL (SLA Breached)"),
    ("CTRL-04", "Vendor File Completeness", "Vendor Mgmt", "Daily", "Data Eng", "FAIL (Missing Files)"),
    ("CTRL-05", "Transaction Classification Accuracy", "Data Ingestion", "Daily", "Data Eng",
     "FAIL (Unmapped Actions)"),
    ("CTRL-06", "Internal Ledger Roll-Forward", "Accounting", "Daily", "FinOps Team", "FAIL (Balance Drift)"),
    ("CTRL-07", "Data Types & Nullability Audit", "Database Admin", "Weekly", "DBA", "FAIL (Null Fields)"),
    ("CTRL-08", "Primary & Foreign Key Validation", "Database Admin", "Weekly", "DBA", "FAIL (Orphan Rows)"),
    ("CTRL-09", "High Dollar Exposure Alerting", "Risk Mgmt", "Real-time", "Risk Officer",
     "FAIL (Criticals Present)"),
    ("CTRL-10", "Root Cause Tracking", "Operations", "Daily", "Ops Analyst", "FAIL (Causes Missing)"),
]

# Anomaly thresholds.
NEGATIVE_BALANCE_WARN = 0
NEGATIVE_BALANCE_HIGH = -5000
EXCESS_CASH = 25000
LARGE_MOVEMENT = 10000
Z_SCORE = 3.0
IQR_MULTIPLIER = 1.5
MIN_GROUP_ROWS = 5
CONCENTRATION_TOP_N = 3

# Column names accepted for optional inputs, best first.
CASH_AMOUNT_NAMES = ["cash_impact", "amount", "transaction_amount", "net_amount"]
CASH_DATE_NAMES = ["transaction_date", "business_date", "trade_date", "date"]
LEDGER_BALANCE_NAMES = ["ending_cash_balance", "cash_balance", "ledger_balance", "balance"]
LEDGER_DATE_NAMES = ["balance_date", "business_date", "ledger_date", "date"]

# Anomaly type -> recommended action in the summary.
ANOMALY_ACTIONS = {
    "NEGATIVE_CASH_BALANCE": "Review funding, settlement timing, and injected breaks.",
    "EXCESS_CASH_BALANCE": "Confirm whether idle cash or posting error exists.",
    "LARGE_DAILY_CASH_MOVEMENT": "Review cash transactions supporting the movement.",
    "STATISTICAL_OUTLIER_Z_SCORE": "Secondary review -- confirm balance is expected for this account.",
    "STATISTICAL_OUTLIER_IQR": "Secondary review -- confirm balance is expected for this account.",
    "HIGH_BREAK_CONCENTRATION_ACCOUNT": "Prioritize reconciliation review for concentrated accounts.",
    "HIGH_BREAK_CONCENTRATION_CATEGORY": "Review systemic cause of dominant break category.",
    "HIGH_EXCEPTION_CONCENTRATION": "Perform root-cause review for recurring HIGH exceptions.",
    "LARGE_CASH_TRANSACTION": "Verify supporting documentation for large cash inflow/outflow.",
    "LEDGER_NEGATIVE_BALANCE": "Investigate internal ledger funding or settlement entry.",
    "LEDGER_EXCESS_BALANCE": "Confirm internal ledger balance is expected.",
    "LEDGER_LARGE_DAILY_MOVEMENT": "Verify internal ledger movement against custodian balance.",
}
DEFAULT_ANOMALY_ACTION = "Review supporting source records and related exceptions."

# Inputs named in the validation summary, and the number of check families per suite.
ANOMALY_INPUTS = ("custodian_balances.csv, reconciliation_breaks.csv, exception_log.csv "
                  "(+ optional: cash_transactions.csv, internal_ledger.csv)")
VENDOR_INPUTS = "vendor_files.csv"
QUALITY_INPUTS = ("custodian_balances.csv, reconciliation_breaks.csv, exception_log.csv, "
                  "vendor_files.csv, raw_stock_transactions.csv")
ANOMALY_CHECK_FAMILIES = 8
VENDOR_CHECK_FAMILIES = 6
