"""Fingerprints find lost, added and changed rows, and the tie-outs fail on them."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks, fingerprints
from ledgerloom.sources import tables
from tests.conftest import rows_of

ROWS = "account_id bigint;day date;amount decimal(19,4);note string"


def test_differences_equal_a_comparison_key_by_key(frame, spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), f"2020-01-{rng.randint(1, 28):02}", rng.randint(0, 9), rng.choice([None, "a", ""])) for _ in range(600)]
    copy = list(rows)
    rng.shuffle(copy)
    for _ in range(6):
        copy.pop()
    copy[3] = (*copy[3][:3], "changed")
    copy += [(99, "2020-02-01", 1, None)] * 2 + [copy[7]]
    want = set()
    for key in {r[:2] for r in rows + copy}:
        a, b = sorted((r for r in rows if r[:2] == key), key=repr), sorted((r for r in copy if r[:2] == key), key=repr)
        if a != b:
            want.add((key[0], key[1], "LOST" if not b else "ADDED" if not a else "CHANGED", len(a), len(b)))
    for ranges in (1, 8, fingerprints.RANGES):
        found = fingerprints.differences(frame(ROWS, *rows), frame(ROWS, *copy).repartition(5), ["account_id", "day"], ranges)
        assert {(r[0], str(r[1]), *r[2:]) for r in found.collect()} == want
    same = fingerprints.agreement(frame(ROWS, *rows), frame(ROWS, *rows[::-1]).select("note", "amount", "day", "account_id"), ["account_id"]).first()
    assert tuple(same) == (600, 600, 0)
    assert tuple(fingerprints.agreement(frame(ROWS, *rows).where("false"), frame(ROWS, *rows).where("false"), ["day"]).first()) == (0, 0, 0)


def test_values_do_not_change_places_with_nulls(frame):
    schema = "k bigint;a string;b string"
    assert fingerprints.differences(frame(schema, (1, "x", None)), frame(schema, (1, None, "x")), ["k"]).count() == 1
    with pytest.raises(ValueError, match="columns differ"):
        fingerprints.agreement(frame(schema, (1, "x", None)), frame("k bigint;a string", (1, "x")), ["k"])


def test_only_differing_ranges_are_compared(frame, spark):
    left = spark.range(50_000).withColumn("v", F.col("id") * 2)
    right = left.withColumn("v", F.when(F.col("id") == 4321, 0).otherwise(F.col("v"))).where("id <> 17")
    assert rows_of(fingerprints.differences(left, right, ["id"])) == [(17, "LOST", 1, 0), (4321, "CHANGED", 1, 1)]
    assert fingerprints.fingerprints(left, right, ["id"]).where("differ").count() == 2


TABLES = {
    "cash": ("transaction_id bigint;amount decimal(19,4)", [(n, n) for n in range(9)]),
    "trades": ("transaction_id bigint;shares decimal(28,8)", [(n % 4, n) for n in range(9)]),
    "ledger": ("account_id bigint;ledger_date date;cash_balance decimal(19,4)", [(n, "2020-01-01", n) for n in range(9)]),
    "custodian": ("account_id bigint;balance_date date;injection_id int", [(n, "2020-01-01", None) for n in range(9)]),
    "breaks": ("break_id bigint;break_category string", [(n, "CASH_BALANCE_BREAK" if n % 2 else "SHARE_QUANTITY_BREAK") for n in range(8)]),
    "log": ("exception_id bigint;dollar_exposure decimal(19,4);evidence_file string", [(n, n, "file") for n in range(8)]),
}
NAMES = dict(zip(TABLES, ["Cash Transaction Rows", "Security Transaction Rows", "Internal Ledger Rows", "Custodian Balance Rows",
                          "Reconciliation Break Rows", "Exception Log Rows"]))


def test_tie_outs_fail_for_the_table_that_lost_or_altered_a_row(frame, workspace):
    source = {name: frame(schema, *rows) for name, (schema, rows) in TABLES.items()}
    published = {name: tables.overwrite_table(df, workspace.path(f"given-out-{name}")) for name, df in source.items()}
    rollforward = frame("account_id bigint", (1,)).where("false")
    validation = frame("injection_id int;detection_status string", *[(n, "DETECTED") for n in range(8)])
    run = lambda copies: {r.check_name: r.status for r in checks.tie_outs(source, copies, rollforward, validation).collect()}
    assert set(run(published).values()) == {"PASS"} and len(run(published)) == 14
    for name, df in published.items():
        key, last = df.columns[0], df.columns[-1]
        one = F.col(key) == 3
        kind = df.schema[last].dataType
        altered = df.withColumn(last, F.when(one, F.lit("5").cast(kind)).otherwise(F.col(last)))
        assert run(published | {name: df.where(~one)})[NAMES[name]] == "FAIL"
        got = run(published | {name: altered})
        assert got[NAMES[name]] == "FAIL" and all(got[NAMES[other]] == "PASS" for other in NAMES if other != name)
        where = fingerprints.differences(source[name], altered, checks.PUBLISHED_KEYS[name]).collect()
        assert [(r[key], r.difference) for r in where] == [(3, "CHANGED")]
