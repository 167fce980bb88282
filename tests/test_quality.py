
from ledgerloom.operators import quality
from ledgerloom.operators.quality import QualitySpec
from tests.conftest import rows_of


def results(df, spec, *families):
    return [tuple(r)[2:] for r in quality.table_checks(df, spec, list(families) or None)[0].orderBy("check_id").collect()]


def test_messages_of_failing_checks(frame):
    rows = [(None if n < 1533 else str(n), "1") for n in range(3299)]
    got = results(frame("ID string;Ticker string", *rows), QualitySpec("raw.csv", required=["ID", "Ticker"], ids=["ID"]),
                  "null_required", "duplicate_id")
    assert got == [
        ("NULL_REQUIRED_FIELD", "FAIL", 1533, "HIGH", "'ID' has 1,533 null values (46.5% of rows) in raw.csv", "Investigate upstream source for missing 'ID' values"),
        ("NULL_REQUIRED_FIELD", "PASS", 0, "INFO", "'Ticker' — no nulls found", "No action required"),
        # Empty ids are equal to each other, and every copy counts.
        ("DUPLICATE_ID", "FAIL", 1533, "HIGH", "'ID' contains 1,533 duplicate values in raw.csv", "Deduplicate on 'ID'; investigate source for re-sends or join issues"),
    ]


def test_few_nulls_are_medium(frame):
    df = frame("a string", *[(None if n == 0 else "x",) for n in range(10)])
    assert results(df, QualitySpec("f", required=["a"]), "null_required")[0][3] == "MEDIUM"  # exactly 10 %
    assert results(df.where("a is not null").limit(8).unionByName(df.where("a is null")), QualitySpec("f", required=["a"]), "null_required")[0][3] == "HIGH"


def test_missing_columns(frame):
    df = frame("a string", ("x",), ("y",))
    spec = QualitySpec("f", required=["r"], ids=["i"], dates=["d"], numbers=["n"], statuses={"s": ["A"]}, critical=["c"])
    assert [r[:4] for r in results(df, spec)] == [
        ("MISSING_COLUMN", "FAIL", 2, "HIGH"), ("DUPLICATE_ID", "FAIL", 0, "HIGH"), ("INVALID_DATE", "FAIL", 0, "MEDIUM"),
        ("NON_NUMERIC_AMOUNT", "FAIL", 0, "HIGH"), ("MISSING_ACCOUNT_ID", "PASS", 0, "INFO"), ("INVALID_STATUS_VALUE", "PASS", 0, "INFO"),
        ("DUPLICATE_FULL_ROW", "PASS", 0, "INFO"), ("NULL_CRITICAL_FIELD", "FAIL", 0, "HIGH")]


def test_bad_values(frame):
    df = frame("account_id string;d string;n string;s string", ("1", "2020-01-01", "1.5", " open "), ("0", "nope", "x", "shut"),
               (None, None, None, None), ("a", "2020-13-01", "1e3", "ajar"), ("a", "2020-13-01", "1e3", "ajar"))
    spec = QualitySpec("f", dates=["d"], numbers=["n"], statuses={"s": ["OPEN"]}, critical=["s"])
    got = results(df, spec)
    assert [(r[0], r[2]) for r in got] == [
        ("INVALID_DATE", 3), ("NON_NUMERIC_AMOUNT", 1), ("MISSING_ACCOUNT_ID", 2), ("INVALID_STATUS_VALUE", 3),
        ("DUPLICATE_FULL_ROW", 1), ("NULL_CRITICAL_FIELD", 1)]
    assert got[3][4] == "'s' has 3 unexpected values in f. Expected: ['OPEN']. Found (sample): ['ajar', 'shut']"
    assert got[4][4] == "1 fully duplicate rows detected in f"


def test_repeated_rows_tell_empty_from_missing(frame):
    df = frame("a string;b string", ("", None), (None, ""), ("x", "y"), ("x", "y"), ("x", "y"), ("xy", ""), ("x", "y"))
    assert quality.repeated_row_count(df).first()[0] == 3


def test_suite_numbers_checks_across_tables_and_reports_missing_ones(frame, spark):
    df = frame("a string", ("x",))
    got = quality.dq_suite(spark, [(QualitySpec("one", required=["a"]), df), (QualitySpec("two"), None), (QualitySpec("three", required=["a"]), df)])
    assert rows_of(got, "check_id", "input_file", "check_name", "check_status") == [
        (1, "one", "NULL_REQUIRED_FIELD", "PASS"), (2, "one", "MISSING_ACCOUNT_ID", "PASS"), (3, "one", "DUPLICATE_FULL_ROW", "PASS"),
        (4, "two", "FILE_NOT_FOUND", "FAIL"), (5, "three", "NULL_REQUIRED_FIELD", "PASS"), (6, "three", "MISSING_ACCOUNT_ID", "PASS"),
        (7, "three", "DUPLICATE_FULL_ROW", "PASS")]
    assert tuple(quality.dq_pass_rate(got).first()) == (7, 1, 85.7, 1, 0, 0)


def test_default_specs_run_76_checks(spark):
    """The five default tables give as many checks as their columns call for."""
    total = 0
    for spec in quality.DEFAULT_SPECS:
        names = dict.fromkeys([*spec.required, *spec.ids, *spec.dates, *spec.numbers, *spec.statuses, *spec.critical])
        df = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
        total += quality.table_checks(df, spec)[1] - 1
    assert total == 76


def test_profile_exact_and_sketched(frame):
    df = frame("a string;b string", *[(str(-n) if n % 2 else None, "k") for n in range(100)])
    exact = {r.column_name: tuple(r)[1:] for r in quality.column_profile(df).collect()}
    assert exact == {"a": (100, 50, 50.0, 50, "-1, -11, -13", 50), "b": (100, 0, 0.0, 1, "k", 0)}
    sketched = {r.column_name: tuple(r)[1:4] + tuple(r)[5:] for r in quality.column_profile(df, exact=False).collect()}
    assert sketched == {k: v[:3] + v[4:] for k, v in exact.items()}


def test_row_counts_share_one_pass(frame):
    df = frame("a string;b string", ("x", "y"))
    plan = quality.table_checks(df, QualitySpec("f", required=["a", "b"], dates=["a"], numbers=["b"], critical=["a"]),
                                ["null_required", "invalid_date", "non_numeric", "critical_null"])[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
