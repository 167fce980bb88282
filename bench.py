"""Time the rebuild stage by stage: one JSON line on standard output.

Stages run in pipeline order on one fresh workspace, so a stage pays for the layers it is the first
to need and reuses those written before it. ``ledger_by_customer`` stresses the day grid: every
customer is an account. Results go to a sink that discards them after computing every row.
"""

import json
import os
import time

from pyspark.sql import functions as F

from ledgerloom.operators import ledger, staging
from ledgerloom.plans import catalog
from ledgerloom.plans.pipeline import Pipeline
from ledgerloom.session import local_shared_folder, spark_session

STAGES = [
    "stage_clean", "cash_transactions", "security_transactions", "ledger_balances", "positions", "rollforward_breaks",
    "rollforward_lag_tieout", "control_total_tieout", "cash_recon", "position_recon", "transaction_match",
    "recon_breaks", "exception_log", "injection_validation", "exception_summary", "kpi_cards", "large_movement",
    "statistical_outliers", "anomaly_flags", "vendor_suite", "dq_suite", "column_profile", "dashboard_measures",
]


def ledger_by_customer(pipeline: Pipeline):
    staged = pipeline.staged_orders(account=F.col("o_custkey"))
    accounts = pipeline.table("customer").select(F.col("c_custkey").alias("account_id"))
    return ledger.ledger_balances(staging.cash_transactions(staged, pipeline.actions()), accounts)


def timed(df_of) -> float:
    start = time.perf_counter()
    df_of().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    local_shared_folder(spark)
    pipeline = Pipeline(spark, folder)
    timed(lambda: pipeline.table("orders").agg(F.count("*")))  # start the JVM's engine outside the figures
    seconds = {name: timed(lambda name=name: catalog.run(name, pipeline)) for name in STAGES}
    seconds["ledger_by_customer"] = timed(lambda: ledger_by_customer(pipeline))
    pipeline.workspace.drop()
    print(json.dumps({
        "metric": "rebuild_and_checks_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "spark": spark.version, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
