import pytest
from pyspark.sql import types as T

from ledgerloom.operators import quality, suites
from ledgerloom.sources import tables
from tests.conftest import rows_of

# Text files; some values cannot be read as what they stand for.
FILES = {
    "custodian_balances.csv": ["custodian_balance_id,account_id,balance_date,custodian_cash_balance,currency",
                               "1,7,2024-01-01,-500.00,GBP", "2,7,2024-01-02,900000.00,GBP", "3,x,no day,abc,GBP"],
    "reconciliation_breaks.csv": ["break_id,account_id,business_date,break_category,internal_value,custodian_value,variance,dollar_exposure",
                                  "0,7,2024-01-01,CASH_BALANCE_BREAK,1,2,-1,10.5", "1,8,2024-01-01,CASH_BALANCE_BREAK,1,2,-1,bad"],
    "exception_log.csv": ["exception_id,account_id,business_date,break_type,severity,variance_amount,root_cause,status,detected_date,due_date,dollar_exposure,aging_days",
                          "0,7,2024-01-01,CASH_BALANCE_BREAK,HIGH,1,Fee,OPEN,2024-01-02,2024-01-04,1,3"],
    "cash_transactions.csv": ["transaction_id,account_id,transaction_date,cash_impact", "1,7,2024-01-01,99999999", "2,7,2024-01-01,?"],
    "internal_ledger.csv": ["account_id,ledger_date,cash_balance", "9,2024-01-01,-1000000"],
    "vendor_files.csv": ["source_file_id,file_name,source_system,receipt_status,record_count,control_total,expected_date,received_timestamp,validation_status",
                         "10,CUST_BAL_20240101.csv,Bank,MISSING,5,1,2024-01-01,,FAILED", "9,CUST_BAL_20240101.csv,Bank,RECEIVED,x,1,2024-13-01,2024-01-01 06:00:00,VALIDATED"],
    "raw_stock_transactions.csv": ["ID,Transaction Date,Ticker,No. of shares,Price / share", 'A,2024-01-01,"T ""x"", y",1,2', "A,never,T,one,2"],
}
# The flags that each file brings forth.
FLAGS = {
    "custodian_balances.csv": {"NEGATIVE_CASH_BALANCE", "EXCESS_CASH_BALANCE", "LARGE_DAILY_CASH_MOVEMENT"},
    "reconciliation_breaks.csv": {"HIGH_BREAK_CONCENTRATION_ACCOUNT", "HIGH_BREAK_CONCENTRATION_CATEGORY"},
    "exception_log.csv": {"HIGH_EXCEPTION_CONCENTRATION"},
    "cash_transactions.csv": {"LARGE_CASH_TRANSACTION"},
    "internal_ledger.csv": {"LEDGER_NEGATIVE_BALANCE"},
}
CHECKED = [s.name for s in quality.DEFAULT_SPECS]


@pytest.fixture
def folder(tmp_path):
    for name, lines in FILES.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    return tmp_path


def run(spark, workspace, folder):
    listed = [suites.anomaly_suite(excess=800_000, movement=500_000), suites.vendor_suite(), suites.quality_suite()]
    return suites.run_suites(spark, str(folder), str(folder / "out"), workspace, "2024-02-01", listed)


@pytest.mark.parametrize("gone", [None, *FILES])
def test_an_absent_file_takes_away_what_depends_on_it(spark, workspace, folder, gone):
    if gone:
        (folder / gone).unlink()
    done = run(spark, workspace, folder)
    flags = {r.anomaly_type for r in done["anomaly_flags"].collect()}
    assert flags == set().union(*[kinds for name, kinds in FLAGS.items() if name != gone])
    assert [r.anomaly_id for r in done["anomaly_flags"].orderBy("anomaly_id").collect()] == list(range(1, done["anomaly_flags"].count() + 1))
    assert {r.anomaly_type for r in done["anomaly_summary"].collect()} == flags
    assert ("vendor_validation_results" in done) == (gone != "vendor_files.csv")
    checks = done["data_quality_results"].collect()
    missing = [r.input_file for r in checks if r.check_name == "FILE_NOT_FOUND"]
    assert missing == ([gone] if gone in CHECKED else [])
    assert {r.input_file for r in checks} == set(CHECKED)
    notes = [r.notes for r in done[suites.SUMMARY].collect()]
    assert len(notes) == 3 and sum("failed to complete" in n for n in notes) == (gone == "vendor_files.csv")
    for name in done:
        assert (folder / "out" / f"{name}.csv").exists()


def test_a_file_without_a_required_column_counts_as_absent_for_its_rules_only(spark, workspace, folder, capsys):
    lines = [",".join(line.split(",")[:7]) for line in FILES["reconciliation_breaks.csv"]]
    (folder / "reconciliation_breaks.csv").write_text("\n".join(lines) + "\n")
    done = run(spark, workspace, folder)
    assert not FLAGS["reconciliation_breaks.csv"] & {r.anomaly_type for r in done["anomaly_flags"].collect()}
    assert "dollar_exposure" in capsys.readouterr().out
    absent = done["data_quality_results"].where("input_file = 'reconciliation_breaks.csv' and check_name = 'MISSING_COLUMN'")
    assert absent.count() == 1


def test_nothing_there_fails_the_suites_but_the_checks(spark, workspace, tmp_path):
    done = run(spark, workspace, tmp_path)
    assert set(done) == {"data_quality_results", suites.SUMMARY}
    assert [r.check_name for r in done["data_quality_results"].collect()] == ["FILE_NOT_FOUND"] * 5
    rows = {r.input_file: (r.checks_performed, r.pass_rate) for r in done[suites.SUMMARY].collect()}
    assert sorted(rows.values(), key=repr) == [(0, None), (0, None), (5, 0.0)]


def test_unreadable_values_are_missing_for_rules_and_failures_for_checks(spark, workspace, folder):
    done = run(spark, workspace, folder)
    assert rows_of(done["anomaly_flags"].where("anomaly_type like 'HIGH_BREAK%ACCOUNT'"), "account_id") == [(7,)]
    failed = {(r.input_file, r.check_name) for r in done["data_quality_results"].where("check_status = 'FAIL'").collect()}
    assert any(f == "raw_stock_transactions.csv" and "DATE" in c for f, c in failed)
    issues = {(r.issue_type, r.actual_status) for r in done["vendor_validation_results"].collect()}
    assert ("INVALID_DATE", "INVALID_EXPECTED_DATE") in issues and {"MISSING_FILE", "DUPLICATE_FILE_NAME"} <= {kind for kind, _ in issues}


def test_written_text_comes_back_as_it_was(spark, tmp_path):
    values = [None, " a ", 'say "x", y', "two\nlines", "back\\slash\\", "é,ü", "'"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, text string").coalesce(1)
    tables.write_csv(df, str(tmp_path / "t.csv"))
    back = tables.read_csv(spark, str(tmp_path / "t.csv"), df.schema)
    assert [r.text for r in back.orderBy("n").collect()] == values


def test_typed_keeps_other_columns(frame):
    df = frame("a string;b string", ("1", "x"), ("no", "y"))
    got = suites.typed(df, T.StructType().add("a", "long").add("gone", "date"))
    assert rows_of(got) == [(1, "x"), (None, "y")] and got.columns == ["a", "b"]


def test_a_file_is_parsed_once_for_all_suites_that_read_it(spark, workspace, folder):
    seen = []

    def keep(spark, inputs, workspace):
        seen.append(inputs["custodian_balances.csv"])
        return {}
    source = suites.Source("custodian_balances.csv", ("account_id",))
    suites.run_suites(spark, str(folder), str(folder / "out"), workspace, "2024-02-01", [suites.Suite(n, (source,), keep) for n in "ab"])
    assert seen[0].inputFiles() == seen[1].inputFiles()
    assert not any(f.endswith(".csv") for f in seen[0].inputFiles())
    assert rows_of(seen[0], "account_id", "custodian_cash_balance") == [("7", "-500.00"), ("7", "900000.00"), ("x", "abc")]
