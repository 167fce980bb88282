"""Compare every registered query with its SQL: ``python -m tests.parity [sf] [name ...]``."""

import math
import sys
import time

import duckdb

import __spark_entry__ as entry_module
from ledgerloom.session import spark_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(f"{float(v):.12g}") + 0.0
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, folder: str, name: str, sql: str) -> tuple[str, int]:
    df = entry_module.queries()[name](spark, folder)
    got = rows(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}", len(got)
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lack = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} / {len(want)}; only here {extra}; only there {lack}", len(got)
    return "", len(got)


def main() -> None:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    spark = spark_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = duck(folder), entry_module.oracle_sql(), 0
    for name in sys.argv[2:] or entry_module.queries():
        start = time.time()
        try:
            problem, n = compare(spark, con, folder, name, texts[name])
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} rows={n} {time.time() - start:.1f}s {problem[:1200]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
