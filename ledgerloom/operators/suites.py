"""Validation suites over a folder of CSV files, each with the inputs it declares.

A file that is absent or lacks a required column takes away just what depends on it: the rules that
read it, or the suite when nothing is left of it. Results are written as CSV; the summary is told from
what was written.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.columns import MONEY, quoted
from ledgerloom.operators import anomaly, quality, vendor
from ledgerloom.sources import tables
from ledgerloom.sources.schemas import CASH_TRANSACTIONS, EXCEPTION_LOG, RECONCILIATION_BREAKS
from ledgerloom.sources.workspace import Workspace

Tables = dict[str, DataFrame | None]


@dataclass(frozen=True)
class Source:
    """A file that a suite reads. Columns that ``types`` names are read as such, the others as text."""

    file: str
    required: tuple[str, ...] = ()
    types: T.StructType = field(default_factory=T.StructType)
    optional: bool = False


@dataclass(frozen=True)
class Suite:
    """``run`` gives the named results of the inputs that are there, or none when it cannot run."""

    name: str
    sources: tuple[Source, ...]
    run: Callable[[SparkSession, Tables, Workspace], dict[str, DataFrame]]


def typed(df: DataFrame, types: T.StructType) -> DataFrame:
    """Text columns as their types, unreadable values missing; other columns stay as they are."""
    known = {f.name: f.dataType for f in types}
    return df.select(*[quoted(c).try_cast(known[c]).alias(c) if c in known else quoted(c) for c in df.columns])


def load(spark: SparkSession, folder: str, source: Source, workspace: Workspace, texts: dict[str, DataFrame]) -> DataFrame | None:
    """A source's file with its types, or none. Its text is parsed once and kept in ``texts``: each rule scans what was written."""
    df = tables.read_table(spark, f"{folder.rstrip('/')}/{source.file}", source.required, source.optional)
    if df is None:
        return None
    if source.file not in texts:
        texts[source.file] = workspace.write(df, "suite-text") if df.columns else df
    return typed(texts[source.file], source.types)


_BALANCES = T.StructType().add("account_id", "long").add("balance_date", "date").add("custodian_cash_balance", MONEY)
_LEDGER = T.StructType().add("account_id", "long")

# Files of the anomaly suite with the columns each must have.
ANOMALY_SOURCES = (
    Source("custodian_balances.csv", ("account_id", "balance_date", "custodian_cash_balance"), _BALANCES),
    Source("reconciliation_breaks.csv", ("account_id", "business_date", "break_category", "dollar_exposure"), RECONCILIATION_BREAKS),
    Source("exception_log.csv", ("severity", "root_cause", "account_id"), EXCEPTION_LOG),
    Source("cash_transactions.csv", ("account_id",), CASH_TRANSACTIONS, optional=True),
    Source("internal_ledger.csv", ("account_id",), _LEDGER, optional=True),
)
VENDOR_SOURCES = (Source("vendor_files.csv", (
    "source_file_id", "file_name", "source_system", "receipt_status", "record_count", "expected_date", "received_timestamp",
    "validation_status"), T.StructType().add("source_file_id", "long")),)


def anomaly_suite(excess: float = fixed.EXCESS_CASH, movement: float = fixed.LARGE_MOVEMENT, z_limit: float = fixed.Z_SCORE) -> Suite:
    """Flags and their summary; none where not one of the files is there."""
    def run(spark: SparkSession, inputs: Tables, workspace: Workspace) -> dict[str, DataFrame]:
        found = anomaly.anomaly_flags(workspace, *[inputs[s.file] for s in ANOMALY_SOURCES], excess, movement, z_limit)
        if found is None:
            return {}
        return {"anomaly_flags": found, "anomaly_summary": anomaly.anomaly_summary(found)}
    return Suite("anomaly_detection", ANOMALY_SOURCES, run)


def vendor_suite() -> Suite:
    def run(spark: SparkSession, inputs: Tables, workspace: Workspace) -> dict[str, DataFrame]:
        registry = inputs["vendor_files.csv"]
        return {} if registry is None else {"vendor_validation_results": vendor.vendor_suite(registry, workspace)}
    return Suite("vendor_file_validation", VENDOR_SOURCES, run)


def quality_suite(specs: list[quality.QualitySpec] = quality.DEFAULT_SPECS) -> Suite:
    """Checks of whole files as text. A column that is absent fails its checks, so none is required to load a file."""
    def run(spark: SparkSession, inputs: Tables, workspace: Workspace) -> dict[str, DataFrame]:
        return {"data_quality_results": quality.dq_suite(spark, [(s, inputs[s.name]) for s in specs])}
    return Suite("data_quality_checks", tuple(Source(s.name, optional=True) for s in specs), run)


def default_suites() -> list[Suite]:
    return [anomaly_suite(), vendor_suite(), quality_suite()]


SUMMARY = "python_validation_summary"


def run_suites(spark: SparkSession, folder: str, out: str, workspace: Workspace, run_date: str, suites: list[Suite] | None = None) -> dict[str, DataFrame]:
    """Run the suites on the files of ``folder`` and write each result to ``out`` as ``<name>.csv``.

    Returns readers of the written results by name, and of the summary with one row for each of the three known
    suites; a suite without a result is one that failed there. Each result is computed once: what
    follows from it, the summary too, reads what was written.
    """
    done: dict[str, DataFrame] = {}
    texts: dict[str, DataFrame] = {}
    for suite in suites if suites is not None else default_suites():
        inputs = {s.file: load(spark, folder, s, workspace, texts) for s in suite.sources}
        for name, df in suite.run(spark, inputs, workspace).items():
            done[name] = _written(df, f"{out.rstrip('/')}/{name}.csv")
    if done:
        summary = anomaly.validation_summary(
            run_date, done.get("anomaly_flags"), done.get("vendor_validation_results"), done.get("data_quality_results"))
        done[SUMMARY] = _written(summary, f"{out.rstrip('/')}/{SUMMARY}.csv")
    return done


def _written(df: DataFrame, path: str) -> DataFrame:
    tables.write_csv(df, path)
    return tables.read_csv(df.sparkSession, path, df.schema)
