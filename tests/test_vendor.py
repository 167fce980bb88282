import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import vendor

FILES = ("source_file_id bigint;file_name string;expected_date string;receipt_status string;received_timestamp string;"
         "validation_status string;record_count string")


def one(n, name="CUST_BAL_20200101.csv", expected="2020-01-01", status="RECEIVED", got="2020-01-01 06:00:00", valid="VALIDATED", count="50"):
    return (n, name, expected, status, got, valid, count)


@pytest.mark.parametrize("name,kind", [("CUST_BAL_20220815.csv", "CUST_BAL"), ("A_20220815_B_20220816.csv", "A"), ("plain.tar.gz", "plain"),
                                       ("_20220815.csv", "_20220815"), (None, "UNKNOWN"), ("noext", "noext")])
def test_file_types(frame, name, kind):
    assert frame("f string", (name,)).select(vendor.file_type(F.col("f"))).first()[0] == kind


def test_suite_lists_rules_in_order(frame, workspace):
    files = frame(
        FILES, one(1, status=" missing ", got=None), one(2, got="2020-01-01 10:00:00"), one(3, got="2020-01-01 11:30:00"),
        one(4, "CUST_BAL_20200101_2.csv"), one(5, "B_20200102.csv", "2020-01-02", count="9", got="2020-01-02 06:00:00"),
        one(6, "B_20200103.csv", "2020-01-03", count="1501", got="2020-01-03 06:00:00"),
        one(7, "B_20200104.csv", "bad", count=None), one(8, "B_20200105.csv", "2020-01-05", status="MISSING", got=None),
        one(9, "B_20200106.csv", "2020-01-06", valid=" failed", got="2020-01-06 06:00:00"))
    got = vendor.vendor_suite(files, workspace).orderBy("validation_id").collect()
    assert [(r.issue_type, r.severity, r.file_date, r.record_count) for r in got] == [
        ("MISSING_FILE", "HIGH", "2020-01-01", 50.0), ("MISSING_FILE", "HIGH", "2020-01-05", 50.0),
        ("LATE_FILE", "MEDIUM", "2020-01-01", 50.0),  # 10:00 is on time
        ("DUPLICATE_FILE_NAME", "HIGH", "2020-01-01", 50.0), ("DUPLICATE_DATE_FILE_TYPE", "MEDIUM", "2020-01-01", 200.0),
        ("LOW_RECORD_COUNT", "HIGH", "2020-01-02", 9.0), ("HIGH_RECORD_COUNT", "MEDIUM", "2020-01-03", 1501.0),
        ("INVALID_DATE", "HIGH", "bad", None), ("INVALID_DATE", "MEDIUM", "2020-01-01", 50.0),  # only the exact code excuses a missing time
        ("FAILED_VALIDATION_STATUS", "HIGH", "2020-01-06", 50.0)]
    assert [r.validation_id for r in got] == list(range(1, 11))
    assert got[2].review_action == "File received ~1.5h after deadline; review SLA; investigate delay"
    assert got[5].actual_status == "9 records" and got[5].expected_status == ">= 10 records"


def test_no_issue_keeps_the_schema(frame, workspace):
    got = vendor.vendor_suite(frame(FILES, one(1)), workspace)
    assert got.count() == 0 and got.columns[0] == "validation_id" and len(got.columns) == 10


def test_single_file_rules_share_one_scan(frame):
    files = vendor.prepared(frame(FILES, one(1)))
    plan = vendor._hits(files, vendor._missing(), *vendor._bounds(10, 1500))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") <= 1
