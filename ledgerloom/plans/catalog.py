"""Every operator as a named query on the driver tables."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import match_key, quoted
from ledgerloom.operators import (
    anomaly, checks, exceptions, files, fingerprints, ids, ledger, months, quality, recon, reports, staging, suites, vendor,
)
from ledgerloom.plans.pipeline import (
    EXCESS_CASH, LARGE_MOVEMENT, LATE_ALL, LATE_FROM, LEDGER_DAYS, MISPOSTING, MISSING_POSITION_FILE, RECLASSIFIED_TICKER, REVIEW_DATE, Z_SCORE, Pipeline,
)
from ledgerloom.sources import tables

Query = Callable[[Pipeline], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Types that compare alike across engines: dates as text, decimals as doubles, whole numbers long."""
    def show(field: T.StructField):
        c, kind = quoted(field.name), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        return c.alias(field.name)
    return df.select(*[show(f) for f in df.schema.fields])


def run(name: str, pipeline: Pipeline) -> DataFrame:
    return plain(QUERIES[name](pipeline))


# Sources and sinks

@query
def read_transactions(p: Pipeline) -> DataFrame:
    path = p.workspace.path("raw-csv")
    text = p.raw().orderBy("source_row_id").drop("source_row_id")
    (text.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    rows = tables.read_csv_numbered(p.spark, path, p.workspace, start=0)
    return rows.select("source_row_id", F.col("Action").alias("action"), quoted("Transaction Date").alias("tx_date"),
                       quoted("Total (GBP)").alias("total"), F.col("ID").alias("id"), F.col("Notes").alias("notes"))


def _read_report(p: Pipeline, read) -> DataFrame:
    wanted = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_missing"], "absent": ["a"]}
    out = None
    for name, required in wanted.items():
        df = read(p.spark, f"{p.folder}/{name}.parquet", required)
        if df is None:
            part = p.spark.range(1).select(F.lit(name).alias("table_name"), F.lit("SKIPPED").alias("outcome"),
                                           F.lit(0).alias("row_count"))
        else:
            part = df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), F.lit("LOADED").alias("outcome"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


@query
def read_required(p: Pipeline) -> DataFrame:
    return _read_report(p, tables.read_required)


@query
def read_optional(p: Pipeline) -> DataFrame:
    return _read_report(p, tables.read_optional)


@query
def write_tables(p: Pipeline) -> DataFrame:
    csv, by_month = p.workspace.path("cash-csv"), p.workspace.path("cash-monthly")
    cash = p.cash().select("transaction_id", "account_id", "transaction_date", "cash_impact")
    tables.write_csv(cash, csv)
    tables.write_by_month(cash, by_month, "transaction_date")
    from_csv = p.spark.read.schema(cash.schema).option("header", True).csv(csv).agg(
        F.count("*").alias("csv_rows"), F.sum("cash_impact").alias("csv_total"))
    months = p.spark.read.parquet(by_month)
    return from_csv.withColumns({
        "parquet_rows": months.agg(F.count("*")).scalar(),
        "parquet_total": months.agg(F.sum("cash_impact")).scalar(),
        "months": months.agg(F.count_distinct("year_month")).scalar(),
    })


@query
def seed_if_absent(p: Pipeline) -> DataFrame:
    known = p.table("customer").select((F.col("c_nationkey") % 5).cast("bigint").alias("key"),
                                       F.col("c_mktsegment").alias("segment")).distinct()
    target = known.where("segment <> 'BUILDING'").withColumn("origin", F.lit("kept"))
    new = known.withColumn("origin", F.lit("seeded"))
    return tables.seed_if_absent(new, target, ["key", "segment"])


@query
def table_overwrite(p: Pipeline) -> DataFrame:
    path = p.workspace.path("daily-net-cash")
    tables.overwrite_table(p.cash().select("account_id").distinct(), path)
    return tables.overwrite_table(ledger.daily_net_cash(p.cash()), path)


# Staging

@query
def stage_clean(p: Pipeline) -> DataFrame:
    return p.staged()


@query
def shifted_id_coalesce(p: Pipeline) -> DataFrame:
    return p.raw().select("source_row_id", staging.transaction_id(
        F.col("source_row_id"), F.col("ID"), quoted("Unnamed: 22"), quoted("Unnamed: 23")).alias("source_transaction_id"))


@query
def account_bucket(p: Pipeline) -> DataFrame:
    return p.table("orders").select(
        "o_orderkey", staging.account_bucket(F.col("o_orderkey")).alias("account_id"))


@query
def sentinel_to_null(p: Pipeline) -> DataFrame:
    return p.raw().select("source_row_id", staging.number_or_null(
        quoted("Exchange rate"), "decimal(19,6)").alias("exchange_rate"))


@query
def cast_failure_flags(p: Pipeline) -> DataFrame:
    return p.raw().select(
        "source_row_id", staging.invalid_date(quoted("Transaction Date")).alias("flag_invalid_date"),
        staging.invalid_amount(quoted("Total (GBP)")).alias("flag_invalid_amount"))


@query
def type_mapping(p: Pipeline) -> DataFrame:
    mapping = staging.action_mapping(p.spark).withColumn("_key", match_key(F.col("raw_action")))
    staged = p.staged().withColumn("_key", match_key(F.col("raw_action"))).groupBy("_key").agg(
        F.count("*").alias("rows_mapped"))
    return mapping.join(staged, "_key", "left").drop("_key").fillna(0, ["rows_mapped"])


@query
def cash_transactions(p: Pipeline) -> DataFrame:
    from_orders = p.cash().drop("transaction_id").withColumn("book", F.lit("orders"))
    from_events = staging.cash_transactions(p.staged(), staging.action_mapping(p.spark)).withColumn(
        "book", F.lit("events"))
    return from_orders.unionByName(from_events)


@query
def security_transactions(p: Pipeline) -> DataFrame:
    from_lines = p.trades().drop("transaction_id").withColumn("book", F.lit("lineitem"))
    from_events = staging.security_transactions(p.staged(), staging.action_mapping(p.spark)).withColumn(
        "book", F.lit("events"))
    return from_lines.unionByName(from_events).drop("price_per_share")


@query
def securities_upsert(p: Pipeline) -> DataFrame:
    master = p.securities().where("security_name like 's%' or security_name like 'r%'")
    return staging.securities_upsert(p.staged(), master)


# Ledger and positions

@query
def calendar(p: Pipeline) -> DataFrame:
    return ledger.calendar(p.cash())


@query
def daily_net_cash(p: Pipeline) -> DataFrame:
    return ledger.daily_net_cash(p.cash())


@query
def account_date_grid(p: Pipeline) -> DataFrame:
    return ledger.account_date_grid(p.accounts(), p.cash()).groupBy("account_id").agg(
        F.count("*").alias("days"), F.min("calendar_date").alias("first_day"), F.max("calendar_date").alias("last_day"))


@query
def ledger_balances(p: Pipeline) -> DataFrame:
    return ledger.ledger_balances(p.cash(), p.accounts())


def _early(p: Pipeline, df: DataFrame) -> DataFrame:
    """Transactions without those that come in late: some from a day on, and all of the last weeks."""
    return df.where(~_is_late())


def _is_late():
    return (F.col("transaction_date") >= F.lit(LATE_FROM).cast("date")) & (F.col("transaction_id") % 97 == 0) \
        | (F.col("transaction_date") >= F.lit(LATE_ALL).cast("date"))


def _ledger_table(p: Pipeline) -> str:
    """Ledger by month, written without the late transactions and then rebuilt from their first month on."""
    path = p.workspace.path("ledger-by-month")

    def build() -> DataFrame:
        months.rebuild_ledger(path, _early(p, p.cash()), p.accounts(), p.workspace)
        first = p.cash().where(_is_late()).agg(F.min("transaction_date")).first()[0]
        months.rebuild_ledger(path, p.cash(), p.accounts(), p.workspace, changed=first)
        return months.read_ledger(p.spark, path)
    p.workspace.memo("ledger-by-month", build)
    return path


@query
def ledger_rebuilt_in_part(p: Pipeline) -> DataFrame:
    return months.read_ledger(p.spark, _ledger_table(p))


@query
def ledger_of_days(p: Pipeline) -> DataFrame:
    return months.read_ledger(p.spark, _ledger_table(p), *[date.fromisoformat(d) for d in LEDGER_DAYS])


@query
def positions_rebuilt_in_part(p: Pipeline) -> DataFrame:
    path = p.workspace.path("positions-by-month")

    def build() -> DataFrame:
        months.rebuild_positions(path, _early(p, p.trades()), p.workspace)
        first = p.trades().where(_is_late()).agg(F.min("transaction_date")).first()[0]
        months.rebuild_positions(path, p.trades(), p.workspace, changed=first)
        return months.read_positions(p.spark, path)
    rows, day = p.workspace.memo("positions-by-month", build), F.dayofmonth("position_date")
    return rows.groupBy("account_id", "ticker", F.date_format("position_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("days"), F.sum("share_quantity").alias("share_days"), F.sum(F.col("share_quantity") * day).alias("weighted_shares"),
        F.sum("daily_net_shares").alias("net_shares"), F.sum(F.col("daily_net_shares") * day).alias("weighted_net_shares"))


@query
def daily_net_shares(p: Pipeline) -> DataFrame:
    return ledger.daily_net_shares(p.trades())


@query
def first_trade(p: Pipeline) -> DataFrame:
    return ledger.first_trade(p.trades())


@query
def position_grid(p: Pipeline) -> DataFrame:
    return ledger.position_grid(p.trades()).groupBy("account_id", "ticker").agg(
        F.count("*").alias("days"), F.min("calendar_date").alias("first_day"), F.max("calendar_date").alias("last_day"))


@query
def positions(p: Pipeline) -> DataFrame:
    return ledger.positions(p.trades()).groupBy(
        "account_id", "ticker", F.date_format("position_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("days"), F.sum("share_quantity").alias("share_days"),
        F.min("share_quantity").alias("lowest"), F.max("share_quantity").alias("highest"),
        F.max_by("share_quantity", "position_date").alias("closing"))


@query
def rollforward_breaks(p: Pipeline) -> DataFrame:
    return ledger.rollforward_breaks(p.dented_ledger(), p.cash(), moves=p.moves())


@query
def rollforward_lag_tieout(p: Pipeline) -> DataFrame:
    return ledger.rollforward_lag_tieout(p.dented_ledger(), p.cash(), moves=p.moves())


# Custodian files and overlays

@query
def file_manifest(p: Pipeline) -> DataFrame:
    return files.file_manifest(p.ledger(), p.positions())


@query
def file_link(p: Pipeline) -> DataFrame:
    return p.baseline_balances().groupBy("source_file_id", "balance_date").agg(F.count("*").alias("records"))


@query
def file_control_totals(p: Pipeline) -> DataFrame:
    return files.file_control_totals(p.baseline_balances(), p.expected_files(), "custodian_cash_balance",
                                     fixed.BALANCE_FILE_PREFIX).drop("received_timestamp")


@query
def apply_adjustments(p: Pipeline) -> DataFrame:
    return p.adjusted_balances().where("injection_id is not null")


@query
def apply_misposting(p: Pipeline) -> DataFrame:
    rows = files.apply_misposting(p.baseline_positions(), **MISPOSTING)
    return rows.where("injection_id is not null").select(
        "account_id", "ticker", "position_date", "custodian_share_quantity", "simulation_flag", "injection_id",
        "source_file_id")


@query
def mark_missing_file(p: Pipeline) -> DataFrame:
    return files.mark_missing_file(p.expected_files(), MISSING_POSITION_FILE, fixed.POSITION_FILE_PREFIX)


@query
def control_total_tieout(p: Pipeline) -> DataFrame:
    return files.control_total_tieout(p.custodian_balances(), p.manifest(), "custodian_cash_balance",
                                      fixed.BALANCE_FILE_PREFIX)


# Reconciliation

@query
def cash_recon(p: Pipeline) -> DataFrame:
    return p.cash_comparison()


@query
def position_recon(p: Pipeline) -> DataFrame:
    return p.position_comparison().groupBy("account_id", "ticker", "break_type", "injection_id").agg(
        F.count("*").alias("days"), F.min("business_date").alias("first_day"), F.max("business_date").alias("last_day"),
        F.sum("share_variance").alias("share_variance"), F.sum("internal_shares").alias("internal_shares"),
        F.sum("custodian_shares").alias("custodian_shares"))


@query
def same_day_match(p: Pipeline) -> DataFrame:
    return recon.same_day_match(p.open_cash(), p.cash())


@query
def timing_match(p: Pipeline) -> DataFrame:
    return recon.timing_match(p.open_cash(), p.cash())


@query
def transaction_match(p: Pipeline) -> DataFrame:
    return recon.transaction_match(p.open_cash(), p.cash())


@query
def recon_breaks(p: Pipeline) -> DataFrame:
    return p.breaks()


@query
def severity(p: Pipeline) -> DataFrame:
    return p.breaks().select("break_id", "dollar_exposure", exceptions.severity(F.col("dollar_exposure")).alias("severity"))


@query
def root_cause(p: Pipeline) -> DataFrame:
    return exceptions.with_root_cause(p.breaks(), p.matches()).select("break_id", "break_category", "variance", "root_cause")


@query
def owner_assignment(p: Pipeline) -> DataFrame:
    return p.breaks().select("break_id", "break_category", exceptions.owner(F.col("break_category")).alias("owner"))


@query
def status_sla(p: Pipeline) -> DataFrame:
    return exceptions.with_status(p.breaks(), REVIEW_DATE).select(
        "break_id", "business_date", "status", "detected_date", "due_date", "aging_days", "sla_status",
        "resolution_notes")


@query
def exception_log(p: Pipeline) -> DataFrame:
    return p.log()


@query
def reclassify(p: Pipeline) -> DataFrame:
    log = exceptions.exception_log(p.breaks(), p.matches(), REVIEW_DATE)
    return exceptions.reclassify(log, RECLASSIFIED_TICKER).select("break_id", "break_type", "ticker", "root_cause")


@query
def evidence_assignment(p: Pipeline) -> DataFrame:
    log = exceptions.exception_log(p.breaks(), p.matches(), REVIEW_DATE)
    part = log.withColumn("evidence_file", F.when(F.col("break_id") % 3 == 0, " ").when(F.col("break_id") % 3 == 1, "kept"))
    return exceptions.assign_evidence(part).select("break_id", "root_cause", "evidence_file")


@query
def control_exceptions(p: Pipeline) -> DataFrame:
    log = exceptions.exception_log(p.breaks(), p.matches(), REVIEW_DATE)
    return exceptions.control_exceptions(log, p.adjustments(), REVIEW_DATE)


@query
def recon_review(p: Pipeline) -> DataFrame:
    return recon.recon_review(p.ledger(), p.custodian_balances())


@query
def cash_recon_totals(p: Pipeline) -> DataFrame:
    return recon.cash_recon_totals(p.ledger_by_month(), p.custodian_balances_by_month())


@query
def position_recon_totals(p: Pipeline) -> DataFrame:
    return recon.position_recon_totals(p.positions_by_month(), p.custodian_positions_by_month())


@query
def ordered_id(p: Pipeline) -> DataFrame:
    rows = p.table("orders").select("o_custkey", "o_orderdate", "o_orderkey")
    numbered = ids.ordered_id(rows, ["o_custkey", "o_orderdate", "o_orderkey"], "row_id", p.workspace, start=1, stored=True)
    return numbered.select("row_id", "o_custkey", "o_orderkey")


# Reports

@query
def cash_activity(p: Pipeline) -> DataFrame:
    return reports.cash_activity(p.cash(), p.accounts(), p.actions())


@query
def security_activity(p: Pipeline) -> DataFrame:
    return reports.security_activity(p.trades(), p.accounts(), p.securities(), p.actions()).drop("price_per_share")


@query
def exception_summary(p: Pipeline) -> DataFrame:
    return reports.exception_summary(p.breaks(), p.log())


@query
def recon_summary(p: Pipeline) -> DataFrame:
    return reports.recon_summary(p.breaks())


@query
def exposure_summary(p: Pipeline) -> DataFrame:
    return reports.exposure_summary(p.adjustments(), p.breaks(), p.log())


@query
def root_cause_breakdown(p: Pipeline) -> DataFrame:
    return reports.root_cause_breakdown(p.log())


@query
def cash_break_causes(p: Pipeline) -> DataFrame:
    return reports.cash_break_causes(p.breaks(), p.log())


@query
def share_break_tickers(p: Pipeline) -> DataFrame:
    return reports.share_break_tickers(p.breaks())


@query
def share_break_runs(p: Pipeline) -> DataFrame:
    return reports.share_break_runs(p.breaks())


@query
def cash_type_profile(p: Pipeline) -> DataFrame:
    return reports.cash_type_profile(p.cash())


@query
def security_type_profile(p: Pipeline) -> DataFrame:
    return reports.security_type_profile(p.trades())


def _rollforward(p: Pipeline) -> DataFrame:
    return ledger.rollforward_breaks(p.dented_ledger(), p.cash(), moves=p.moves())


def _validation(p: Pipeline) -> DataFrame:
    return p.workspace.layer(
        "injection-to-break", lambda: checks.injection_to_break(p.adjustments(), p.breaks(), p.log()))


@query
def kpi_cards(p: Pipeline) -> DataFrame:
    return reports.kpi_cards(p.log(), _rollforward(p), _validation(p))


@query
def root_cause_exposure(p: Pipeline) -> DataFrame:
    return reports.root_cause_exposure(p.log())


@query
def owner_mix(p: Pipeline) -> DataFrame:
    return reports.owner_mix(p.log())


@query
def status_mix(p: Pipeline) -> DataFrame:
    return reports.status_mix(p.log())


@query
def exception_aging(p: Pipeline) -> DataFrame:
    return reports.exception_aging(p.log())


@query
def aging_buckets(p: Pipeline) -> DataFrame:
    return reports.aging_buckets(p.log())


@query
def open_by_owner(p: Pipeline) -> DataFrame:
    return reports.open_by_owner(p.log())


@query
def cause_status_pivot(p: Pipeline) -> DataFrame:
    return reports.cause_status_pivot(p.log())


def _controls(p: Pipeline) -> DataFrame:
    number = lambda df, c=None: df.agg(F.count("*") if c is None else c).scalar()
    log, breaks = p.log(), p.breaks()
    nulls = checks.null_critical_fields(log)
    total_nulls = nulls.select(sum((F.col(c) for c in nulls.columns[1:]), F.col(nulls.columns[0]))).scalar()
    orphans = checks.orphan_accounts(p.cash(), p.trades(), p.accounts())
    return reports.control_status(
        cash_breaks=number(breaks, F.count_if(F.col("break_category") == "CASH_BALANCE_BREAK")),
        share_breaks=number(breaks, F.count_if(F.col("break_category") == "SHARE_QUANTITY_BREAK")),
        over_sla=number(log, F.count_if(F.col("sla_status") == "OVER_SLA")),
        missing_files=number(p.manifest(), F.count_if(F.col("receipt_status") == "MISSING")),
        unmapped=number(checks.unmapped_actions(p.staged_orders(), p.actions())),
        rollforward_failures=number(ledger.rollforward_breaks(p.ledger(), p.cash())),
        null_fields=total_nulls,
        orphans=orphans.select(F.col("orphan_cash_transactions") + F.col("orphan_security_transactions")).scalar(),
        criticals=number(log, F.count_if(F.col("severity") == "CRITICAL")),
        causeless=number(log, F.count_if(F.col("root_cause").isNull())),
        one_row=p.spark.range(1).drop("id"))


@query
def control_status(p: Pipeline) -> DataFrame:
    return _controls(p)


@query
def dashboard_measures(p: Pipeline) -> DataFrame:
    return reports.dashboard_measures(p.cash(), p.trades(), p.breaks(), p.log(), _controls(p), _quality(p), _vendor(p),
                                      _anomalies(p))


# Pipeline checks

@query
def row_count_tieout(p: Pipeline) -> DataFrame:
    return checks.row_count_tieout(p.raw(), p.staged())


def _layers(p: Pipeline) -> dict[str, DataFrame]:
    return {"cash_transactions": p.cash(), "security_transactions": p.trades(), "internal_ledger_balances": p.ledger(),
            "custodian_balances": p.custodian_balances(), "positions": p.positions(),
            "custodian_positions": p.custodian_positions(), "reconciliation_breaks": p.breaks(),
            "exception_log": p.log()}


@query
def layer_counts(p: Pipeline) -> DataFrame:
    return checks.layer_counts(_layers(p), p.expected_counts())


@query
def rollforward_status(p: Pipeline) -> DataFrame:
    good = checks.rollforward_status(ledger.rollforward_breaks(p.ledger_by_month(), p.cash(), moves=p.moves(), openings=p.openings()))
    return good.unionByName(checks.rollforward_status(_rollforward(p)))


@query
def duplicate_ids(p: Pipeline) -> DataFrame:
    staged = checks.duplicate_ids(staging.stage_clean(p.loaded_twice()), "source_transaction_id").select(
        F.lit("staging").alias("table_name"), F.col("source_transaction_id").alias("id"),
        F.col("occurrences").alias("duplicate_count"))
    core = checks.duplicate_transaction_ids(p.cash(), p.trades()).withColumn(
        "id", F.col("transaction_id").cast("string")).drop("transaction_id")
    return staged.unionByName(core)


@query
def failed_casts(p: Pipeline) -> DataFrame:
    return checks.failed_casts(p.staged())


@query
def missing_required(p: Pipeline) -> DataFrame:
    return checks.missing_required(p.staged())


@query
def missing_field_matrix(p: Pipeline) -> DataFrame:
    renamed = p.staged().withColumnsRenamed({"source_row_id": "transaction_id", "raw_action": "transaction_type"})
    return checks.missing_field_matrix(p.cash(), renamed)


@query
def unmapped_actions(p: Pipeline) -> DataFrame:
    orders = checks.unmapped_actions(p.staged_orders(), p.actions())
    return orders.unionByName(checks.unmapped_actions(p.staged(), staging.action_mapping(p.spark)))


@query
def broken_security_joins(p: Pipeline) -> DataFrame:
    return checks.broken_security_joins(p.trades(), p.securities())


@query
def orphan_accounts(p: Pipeline) -> DataFrame:
    return checks.orphan_accounts(p.cash(), p.trades(), p.wealthy_accounts())


@query
def negative_positions(p: Pipeline) -> DataFrame:
    return checks.negative_positions(p.positions()).groupBy("account_id", "ticker").agg(
        F.count("*").alias("days"), F.min("share_quantity").alias("lowest"), F.min("position_date").alias("first_day"))


@query
def open_over_sla(p: Pipeline) -> DataFrame:
    return checks.open_over_sla(p.log()).select("exception_id", "account_id", "business_date", "status", "aging_days")


@query
def missing_dates(p: Pipeline) -> DataFrame:
    return checks.missing_dates(p.staged())


@query
def recon_coverage(p: Pipeline) -> DataFrame:
    return checks.recon_coverage(p.ledger(), p.custodian_balances(), p.positions(), p.custodian_positions())


@query
def adjustment_counts(p: Pipeline) -> DataFrame:
    return checks.adjustment_counts(p.adjustments(), p.custodian_balances(), p.custodian_positions())


@query
def missing_files(p: Pipeline) -> DataFrame:
    return checks.missing_files(p.manifest())


@query
def orphan_adjustments(p: Pipeline) -> DataFrame:
    untagged = p.custodian_balances().withColumn(
        "injection_id", F.when(F.col("injection_id") != 2, F.col("injection_id")))
    return checks.orphan_adjustments(untagged)


@query
def adjustment_coverage(p: Pipeline) -> DataFrame:
    return checks.adjustment_coverage(p.adjustments(), p.log())


@query
def injection_validation(p: Pipeline) -> DataFrame:
    return checks.injection_validation(p.adjustments(), p.open_cash(), p.open_positions())


@query
def injection_to_break(p: Pipeline) -> DataFrame:
    return checks.injection_to_break(p.adjustments(), p.breaks(), p.log())


@query
def null_critical_fields(p: Pipeline) -> DataFrame:
    return checks.null_critical_fields(p.log())


@query
def exception_completeness(p: Pipeline) -> DataFrame:
    return checks.exception_completeness(p.log())


def _published(p: Pipeline, sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as they are given out: written, and read back."""
    return {name: p.workspace.memo(f"published-{name}", lambda: tables.overwrite_table(df, p.workspace.path(f"published-{name}")))
            for name, df in sources.items()}


@query
def tie_outs(p: Pipeline) -> DataFrame:
    sources = {"cash": p.cash(), "trades": p.trades(), "ledger": p.ledger(), "custodian": p.custodian_balances(),
               "breaks": p.breaks(), "log": p.log()}
    return checks.tie_outs(sources, _published(p, sources), _rollforward(p), _validation(p))


@query
def table_differences(p: Pipeline) -> DataFrame:
    """Where the ledger and a copy with one balance off, one day gone and one account too many disagree."""
    own = p.ledger()
    copy = p.dented_ledger().select(own.columns).unionByName(
        own.where("account_id = 7 and ledger_date between date'1999-01-01' and date'1999-01-03'").withColumn("account_id", F.col("account_id") + 1000))
    return fingerprints.differences(own, copy, ["account_id", "ledger_date"])


# Data quality

RAW_SPEC = quality.QualitySpec(
    "raw_stock_transactions.csv",
    required=["ID", "Transaction Date", "Ticker", "No. of shares", "Price / share", "Settlement"],
    ids=["ID", "Reference"], dates=["Transaction Date", "Value Date"],
    numbers=["No. of shares", "Price / share", "Total (GBP)", "Net"],
    statuses={"Action": ["DEPOSIT", "WITHDRAWAL", "MARKET BUY", "MARKET SELL"], "Stage": ["A"]},
    critical=["Action", "Ticker", "Route"])
FILES_SPEC = next(s for s in quality.DEFAULT_SPECS if s.name == "vendor_files.csv")


def _family(p: Pipeline, name: str) -> DataFrame:
    return quality.table_checks(p.raw_with_copies(), RAW_SPEC, [name])[0]


@query
def dq_null_required(p: Pipeline) -> DataFrame:
    return _family(p, "null_required")


@query
def dq_duplicate_id(p: Pipeline) -> DataFrame:
    raw = _family(p, "duplicate_id")
    lines = p.table("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"), "l_shipdate")
    spec = quality.QualitySpec("security_transactions.csv", ids=["transaction_id"])
    return raw.unionByName(quality.table_checks(lines, spec, ["duplicate_id"], first_id=3)[0])


@query
def dq_invalid_date(p: Pipeline) -> DataFrame:
    return _family(p, "invalid_date")


@query
def dq_non_numeric(p: Pipeline) -> DataFrame:
    return _family(p, "non_numeric")


@query
def dq_missing_account(p: Pipeline) -> DataFrame:
    raw = _family(p, "missing_account")
    balances = p.table("orders").select((F.col("o_custkey") % 50).alias("account_id"))
    spec = quality.QualitySpec("cash_transactions.csv")
    return raw.unionByName(quality.table_checks(balances, spec, ["missing_account"], first_id=2)[0])


@query
def dq_invalid_status(p: Pipeline) -> DataFrame:
    raw, next_id = quality.table_checks(p.raw_with_copies(), RAW_SPEC, ["invalid_status"])
    return raw.unionByName(quality.table_checks(p.registry(), FILES_SPEC, ["invalid_status"], next_id)[0])


@query
def dq_duplicate_rows(p: Pipeline) -> DataFrame:
    return _family(p, "duplicate_rows")


@query
def dq_critical_null(p: Pipeline) -> DataFrame:
    return _family(p, "critical_null")


ABSENT_SPEC = quality.QualitySpec("absent.csv")


def _checked(p: Pipeline) -> dict[str, DataFrame]:
    return {"custodian_balances.csv": p.custodian_balances(), "reconciliation_breaks.csv": p.breaks(), "exception_log.csv": p.log(),
            "vendor_files.csv": p.registry(), "raw_stock_transactions.csv": p.raw_with_copies()}


def _registry(p: Pipeline) -> DataFrame:
    return p.workspace.layer("registry", p.registry)


def _quality(p: Pipeline) -> DataFrame:
    """Results on the stand-ins; those that the checks scan several times are built once."""
    def build() -> DataFrame:
        given = {**_checked(p), "vendor_files.csv": _registry(p), "raw_stock_transactions.csv": p.workspace.layer("raw-copies", p.raw_with_copies)}
        return quality.dq_suite(p.spark, [(s, given.get(s.name)) for s in [*quality.DEFAULT_SPECS, ABSENT_SPEC]])
    return p.workspace.layer("quality", build)


@query
def dq_suite(p: Pipeline) -> DataFrame:
    return _quality(p)


@query
def dq_pass_rate(p: Pipeline) -> DataFrame:
    return quality.dq_pass_rate(_quality(p))


@query
def column_profile(p: Pipeline) -> DataFrame:
    return quality.column_profile(p.raw_with_copies())


# Vendor files

@query
def vendor_file_type(p: Pipeline) -> DataFrame:
    return vendor.with_file_type(p.registry()).groupBy("file_type").agg(F.count("*").alias("files"))


def _rule(p: Pipeline, rule) -> DataFrame:
    return vendor.issues(rule(vendor.prepared(p.registry())))


@query
def vendor_missing(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.missing_files)


@query
def vendor_late(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.late_files)


@query
def vendor_dup_name(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.duplicate_names)


@query
def vendor_dup_type_date(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.duplicate_type_dates)


@query
def vendor_count_bounds(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.count_bounds)


@query
def vendor_invalid_date(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.invalid_dates)


@query
def vendor_failed_status(p: Pipeline) -> DataFrame:
    return _rule(p, vendor.failed_status)


def _vendor(p: Pipeline) -> DataFrame:
    return p.workspace.memo("vendor", lambda: vendor.vendor_suite(_registry(p), p.workspace))


@query
def vendor_suite(p: Pipeline) -> DataFrame:
    return _vendor(p)


@query
def vendor_issue_counts(p: Pipeline) -> DataFrame:
    one = lambda by: vendor.issue_counts(_vendor(p), by).select(
        F.lit(by).alias("grouping"), F.col(by).alias("value"), "issue_count")
    return one("severity").unionByName(one("issue_type"))


# Anomalies

def _balances(p: Pipeline) -> DataFrame:
    return anomaly.standard_balances(p.custodian_balances(), "balance_date", "custodian_cash_balance")


@query
def neg_balance(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.negative_balances(_balances(p)))


@query
def excess_cash(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.excess_cash(_balances(p), limit=EXCESS_CASH))


@query
def large_movement(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.large_movements(_balances(p), p.workspace, limit=LARGE_MOVEMENT))


def _outliers(p: Pipeline) -> DataFrame:
    """Balances that either test finds, for the rules that share them."""
    return p.workspace.layer("outliers", lambda: anomaly.account_outliers(
        _balances(p), p.workspace, Z_SCORE).where("z_outlier or iqr_outlier"))


@query
def zscore_outlier(p: Pipeline) -> DataFrame:
    return anomaly.z_scores(_balances(p), p.workspace).where(F.abs("z_score") > Z_SCORE).select(
        "account_id", "day", "balance", F.round("z_score", 6).alias("z_score"))


@query
def iqr_outlier(p: Pipeline) -> DataFrame:
    return _outliers(p).where("iqr_outlier").select("account_id", "day", "balance")


@query
def statistical_outliers(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.statistical_outliers(_outliers(p), Z_SCORE))


@query
def break_concentration_account(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.break_concentration_account(p.breaks()))


@query
def break_concentration_category(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.break_concentration_category(p.breaks()))


@query
def exception_concentration(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.exception_concentration(p.log()))


@query
def large_cash_txn(p: Pipeline) -> DataFrame:
    return anomaly.flags(anomaly.large_cash_transactions(p.cash(), LARGE_MOVEMENT))


@query
def ledger_anomalies(p: Pipeline) -> DataFrame:
    parts = anomaly.ledger_anomalies(p.ledger(), p.workspace, EXCESS_CASH, LARGE_MOVEMENT)
    return anomaly.flags(parts[0].unionByName(parts[1]))


def _anomalies(p: Pipeline) -> DataFrame:
    return p.workspace.memo("anomalies", lambda: anomaly.anomaly_flags(
        p.workspace, p.custodian_balances(), p.breaks(), p.log(), p.cash(), p.ledger(), EXCESS_CASH, LARGE_MOVEMENT,
        Z_SCORE, _outliers(p)))


@query
def anomaly_flags(p: Pipeline) -> DataFrame:
    return _anomalies(p)


@query
def anomaly_summary(p: Pipeline) -> DataFrame:
    return anomaly.anomaly_summary(_anomalies(p))


@query
def validation_summary(p: Pipeline) -> DataFrame:
    return anomaly.validation_summary(REVIEW_DATE, _anomalies(p), _vendor(p), _quality(p))


# Suites from files

def _from_files(p: Pipeline) -> dict[str, DataFrame]:
    """Results of the suites on the stand-ins written as text; one file that is checked is not there."""
    def build() -> dict[str, DataFrame]:
        folder = p.workspace.path("suite-inputs")
        given = {**_checked(p), "cash_transactions.csv": p.cash(), "internal_ledger.csv": p.ledger()}
        for name, df in given.items():
            tables.write_csv(df.select(*[quoted(c).cast("string").alias(c) for c in df.columns]), f"{folder}/{name}")
        listed = [suites.anomaly_suite(EXCESS_CASH, LARGE_MOVEMENT, Z_SCORE), suites.vendor_suite(),
                  suites.quality_suite([*quality.DEFAULT_SPECS, ABSENT_SPEC])]
        return suites.run_suites(p.spark, folder, p.workspace.path("suite-results"), p.workspace, REVIEW_DATE, listed)
    return p.workspace.memo("suites", build)


@query
def suite_flags(p: Pipeline) -> DataFrame:
    return _from_files(p)["anomaly_flags"]


@query
def suite_flag_summary(p: Pipeline) -> DataFrame:
    return _from_files(p)["anomaly_summary"]


@query
def suite_vendor_issues(p: Pipeline) -> DataFrame:
    return _from_files(p)["vendor_validation_results"]


@query
def suite_quality(p: Pipeline) -> DataFrame:
    return _from_files(p)["data_quality_results"]


@query
def suite_summary(p: Pipeline) -> DataFrame:
    return _from_files(p)[suites.SUMMARY]
