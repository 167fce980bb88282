from decimal import Decimal as D


from ledgerloom.operators import staging
from ledgerloom.sources.schemas import RAW_TRANSACTION_COLUMNS
from tests.conftest import rows_of


def raw(frame, *rows):
    full = [tuple([r["row"]] + [r.get(c) for c in RAW_TRANSACTION_COLUMNS]) for r in rows]
    df = frame("source_row_id bigint;" + ";".join(f"c{i} string" for i in range(len(RAW_TRANSACTION_COLUMNS))), *full)
    return df.toDF("source_row_id", *RAW_TRANSACTION_COLUMNS)


def test_ids_come_from_shifted_columns(frame):
    df = raw(frame, dict(row=1, ID=" A "), {"row": 2, "ID": "  ", "Unnamed: 22": "B"},
             {"row": 3, "Unnamed: 22": "", "Unnamed: 23": " C"}, dict(row=4))
    staged = staging.stage_clean(df)
    assert [r[0] for r in staged.orderBy("source_row_id").select("source_transaction_id").collect()] == ["A", "B", "C", "GEN-4"]


def test_types_defaults_and_flags(frame):
    df = raw(
        frame,
        {"row": 50, "Action": " Deposit ", "Transaction Date": "2020-04-30", "Total (GBP)": "-10.5", "Time": "9:05:00",
         "Exchange rate": "Not available", "No. of shares": "-3", "Currency (Total)": " "},
        {"row": 51, "Transaction Date": "", "Total (GBP)": "abc", "Time": "25:00:00", "Exchange rate": "1.25"},
        {"row": 52, "Total (GBP)": None})
    a, b, c = staging.stage_clean(df).orderBy("source_row_id").collect()
    assert (a.account_id, a.raw_action, a.total_amount, a.shares) == (1, "Deposit", D("10.5"), D("3"))
    assert (a.transaction_time, a.exchange_rate, a.currency_total) == ("09:05:00", None, "GBP")
    assert (a.flag_invalid_date, a.flag_invalid_amount) == (0, 0)
    assert (b.transaction_time, b.exchange_rate, b.flag_invalid_date, b.flag_invalid_amount) == ("00:00:00", D("1.25"), 1, 1)
    assert (c.flag_invalid_date, c.flag_invalid_amount) == (1, 0)  # nothing to read is no bad amount


def test_cash_and_security_rows_follow_the_mapping(frame, spark):
    common = {"Transaction Date": "2020-01-01", "Ticker": "T", "No. of shares": "2", "Total (GBP)": "100"}
    df = raw(
        frame, {"row": 1, "Action": "Market buy", **common}, {"row": 2, "Action": "MARKET SELL ", **common},
        {"row": 3, "Action": "Deposit", **common}, {"row": 4, "Action": "Card debit", **common},
        {"row": 5, "Action": "Dividend (Demerger)", **common}, {"row": 6, "Action": "Market buy", **common, "Total (GBP)": "x"},
        {"row": 7, "Action": "Market buy", **common, "Transaction Date": None}, {"row": 8, "Action": "Market buy", **common, "Ticker": " "})
    staged, mapping = staging.stage_clean(df), staging.action_mapping(spark)
    assert rows_of(staging.cash_transactions(staged, mapping), "source_row_id", "cash_impact") == [
        (1, D("-100")), (2, D("100")), (3, D("100")), (8, D("-100"))]
    # A bad amount does not keep a trade out; a missing ticker does.
    assert rows_of(staging.security_transactions(staged, mapping), "source_row_id", "security_impact") == [
        (1, D("2")), (2, D("-2")), (6, D("2"))]


def test_new_tickers_take_one_name(frame):
    staged = frame("ticker string;security_name string", ("A", "x"), ("A", "y"), ("B", "z"), (None, "n"))
    master = frame("ticker string;security_name string", ("B", "kept"), (None, "null key"))
    assert rows_of(staging.securities_upsert(staged, master)) == [("A", "y"), ("B", "kept"), (None, "null key")]
