"""Storage forms: raw tables, document tables, or raw tables with the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.plans import filings, statements
from finfacts.sources.archives import unpack_archives
from finfacts.sources.documents import read_documents
from finfacts.sources.manifest import is_staged, staged_manifest
from finfacts.schema import SOURCE_LABELS
from finfacts.sources.raw import read_tables
from finfacts.sources.sinks import save_model

FORMS = ("RAW", "JSON", "NORMALIZED")


def period_folder(year: int, quarter: str, first_year: int = 2000, last_year: int = 2100) -> str:
    """Folder of a requested quarter; a year or quarter out of range is an error."""
    if not first_year <= year <= last_year:
        raise ValueError(f"year must be between {first_year} and {last_year}")
    if quarter not in ("Q1", "Q2", "Q3", "Q4"):
        raise ValueError("quarter must be Q1, Q2, Q3 or Q4")
    return f"{year}{quarter.lower()}"


def stage_period(spark: SparkSession, archives: str, staged: str, period: str) -> bool:
    """Unpack the archive of a period unless it is staged; true if it was unpacked now.

    ``staged`` must exist. A missing archive is an error.
    """
    if not is_staged(staged_manifest(spark, staged), period).isEmpty():
        return False
    found = is_staged(staged_manifest(spark, archives), period).first()
    if found is None or found["archive"] is None:
        raise FileNotFoundError(f"no archive for {period} under {archives}")
    unpack_archives(spark, found["archive"], staged)
    return True


def load_form(
    spark: SparkSession, form: str, root: str, periods: list[str] | None = None,
    on_error: str = "abort", unpacked: bool = False, documents: str = "lines",
    store: str | None = None,
) -> dict[str, DataFrame]:
    """Tables of a storage form; lazy ones unless the normalized form gets a ``store``."""
    form = form.upper()
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}")
    if form == "JSON":
        docs = read_documents(spark, root, periods, documents)
        meta, data = filings.document_tables(docs, ids=True)
        return {"financial_metadata": meta, "financial_data": data}
    tables = read_tables(spark, root, periods, on_error, unpacked)
    if form == "RAW":
        return tables
    return {**tables, **(normalized(tables) if store is None else store_normalized(tables, store))}


def store_normalized(tables: statements.Tables, store: str) -> dict[str, DataFrame]:
    """The normalized form in the order of its dependencies: one pass over the reported values.

    Staging is stored under ``store``; the statement tables are its partitions, the facts
    derive from it and are stored too, and the metrics derive from the facts. Every task
    that makes staging rows distinct has some of all three statements and writes them itself.
    """
    spark = tables["sub"].sparkSession
    save_model(statements.staging(tables), f"{store}/staging", partition_by=["source_file"], mode="replace",
               rebalance=False, compression="zstd")
    staged = spark.read.parquet(f"{store}/staging").select(*statements.STAGING_COLUMNS)
    save_model(statements.facts_from_staging(staged, tables["sub"]), f"{store}/facts", mode="replace",
               compression="zstd")
    facts = spark.read.parquet(f"{store}/facts")
    parts = {s: staged.filter(F.col("source_file") == label) for s, label in SOURCE_LABELS.items()}
    return {
        **{f"stg_{s}": part for s, part in parts.items()},
        **{s: statements.analyst_rows(part, loaded=True) for s, part in parts.items()},
        "fct_financial_statements": facts.withColumn("dbt_loaded_at", F.current_timestamp()),
        "company_metrics": statements.company_metrics_from_facts(facts),
        "fact_financials": statements.fact_financials_from_staging(staged, loaded=True),
    }


def normalized(tables: statements.Tables) -> dict[str, DataFrame]:
    """Staging statements and marts over raw tables."""
    return {
        "stg_balance_sheet": statements.stg_balance_sheet(tables),
        "stg_income_statement": statements.stg_income_statement(tables),
        "stg_cash_flow": statements.stg_cash_flow(tables),
        "fct_financial_statements": statements.fct_financial_statements(tables, load_time=True),
        "company_metrics": statements.company_metrics(tables),
        "balance_sheet": statements.balance_sheet(tables, loaded=True),
        "income_statement": statements.income_statement(tables, loaded=True),
        "cash_flow": statements.cash_flow(tables, loaded=True),
        "fact_financials": statements.fact_financials(tables, loaded=True),
    }
