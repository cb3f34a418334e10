"""Analyst queries by name, over the raw, document and statement tables.

Queries that multiply the filings and the facts of a company are computed from
counts per distinct row (see ``counted_join``), never from the pairs. A full
order ends in enough columns to split rows that agree in the leading ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.operators.aggregates import EXACT, max_where, metric_stats, sum_where, top_k
from finfacts.operators.joins import (
    counted, counted_join, expand_counted, join_doc_tables, join_filing,
)
from finfacts.plans import filings, statements
from finfacts.plans.statements import Tables
from finfacts.schema import CASH_FLOW_TAGS

# Concepts the queries ask for by default.
KEY_BALANCE_CONCEPTS = ("Assets", "Liabilities", "StockholdersEquity")
INCOME_CONCEPTS = ("Revenues", "NetIncomeLoss", "OperatingIncomeLoss")
OPERATING_CASH_FLOW = "NetCashProvidedByUsedInOperatingActivities"
REVENUE, NET_INCOME = "Revenues", "NetIncomeLoss"


def _desc(name: str):
    return F.col(name).desc()


def _data(tables: Tables, concepts: Sequence[str] | None = None, **options) -> DataFrame:
    """Document facts; the concept filter reaches the scans of ``num``, ``pre`` and ``tag``."""
    return filings.financial_data(tables, tags=concepts, **options)


# ---- raw tables ----------------------------------------------------------

def recent_filings(tables: Tables, k: int = 10) -> DataFrame:
    """Latest filings by filing date."""
    sub = tables["sub"].select("name", "form", "filed", "period", "adsh")
    return top_k(sub, [_desc("filed"), F.col("adsh")], k).select("name", "form", "filed", "period")


def top_companies(tables: Tables, k: int = 10) -> DataFrame:
    """Companies with most filings."""
    per_name = tables["sub"].groupBy("name").agg(F.count("*").alias("filing_count"))
    return top_k(per_name, [_desc("filing_count"), F.col("name")], k)


def values_by_tag(
    tables: Tables, tags: Sequence[str] = KEY_BALANCE_CONCEPTS, k: int = 10
) -> DataFrame:
    """Latest reported values of some tags with the company name."""
    num = tables["num"].filter(F.col("tag").isin(*tags)).select("adsh", "tag", "value", "ddate")
    named = join_filing(num, tables["sub"].select("adsh", "name")).drop("adsh")
    order = [_desc("ddate"), F.col("tag"), F.col("value"), F.col("name")]
    return top_k(named, order, k)


def tag_usage(tables: Tables, k: int = 10) -> DataFrame:
    """Tags and labels by number of reported values; both sides are counted before they meet."""
    used = counted(tables["num"], ["tag"])
    labels = counted(tables["tag"], ["tag", "tlabel"])
    usage = counted_join(labels, used, "tag", "usage_count")
    return top_k(usage, [_desc("usage_count"), F.col("tag"), F.col("tlabel")], k)


# ---- document tables -----------------------------------------------------

def data_points(tables: Tables, k: int = 10) -> DataFrame:
    """Companies and countries by number of facts."""
    facts = filings.fact_groups(tables, [F.count("*").alias("_facts")])
    pairs = counted_join(
        counted(filings.financial_metadata(tables), ["symbol", "name", "country"]),
        facts.groupBy("symbol").agg(F.sum("_facts").alias("row_count")), "symbol",
    )
    points = pairs.groupBy("name", "country").agg(F.sum("row_count").alias("data_points"))
    return top_k(points, [_desc("data_points"), F.col("name"), F.col("country")], k)


def balance_sheet_analysis(
    tables: Tables, concepts: Sequence[str] = KEY_BALANCE_CONCEPTS, expand: bool = False
) -> DataFrame:
    """Balance-sheet facts of each company, with how often each row occurs."""
    rows = join_doc_tables(
        filings.financial_metadata(tables), _data(tables, concepts, parts=("bs",)),
        ["name"], ["concept", "value"],
    ).select("symbol", "name", "concept", "value", "row_count").orderBy(
        "symbol", "concept", "name", "value"
    )
    return expand_counted(rows) if expand else rows


def cash_flow_metrics(
    tables: Tables, concepts: Sequence[str] = CASH_FLOW_TAGS, expand: bool = False
) -> DataFrame:
    """Cash-flow facts of each company and period, with how often each row occurs."""
    rows = join_doc_tables(
        filings.financial_metadata(tables), _data(tables, concepts, parts=("cf",)),
        ["name", "year", "quarter"], ["concept", "value"],
    ).select(
        "symbol", "name", "concept", "value", "year", "quarter", "row_count"
    ).orderBy(_desc("year"), _desc("quarter"), "symbol", "concept", "name", "value")
    return expand_counted(rows) if expand else rows


def company_health(
    tables: Tables, assets: str = "Assets", liabilities: str = "Liabilities",
    operating_cash_flow: str = OPERATING_CASH_FLOW,
) -> DataFrame:
    """Summed assets, liabilities and operating cash flow of companies with assets."""
    bs, cf, concept = F.col("data_type") == "bs", F.col("data_type") == "cf", F.col("concept")
    wanted = {
        "total_assets": bs & (concept == assets),
        "total_liabilities": bs & (concept == liabilities),
        "operating_cash_flow": cf & (concept == operating_cash_flow),
    }
    facts = filings.fact_groups(
        tables, [F.sum(F.col("value").cast(EXACT)).alias("value")],
        tags=(assets, liabilities, operating_cash_flow),
    )
    per_symbol = facts.groupBy("symbol").agg(
        *[sum_where(condition).alias(name) for name, condition in wanted.items()]
    )
    names = counted(filings.financial_metadata(tables), ["symbol", "name"])
    totals = names.join(per_symbol, "symbol").select(
        "symbol", "name",
        *[(F.col(n).cast("double") * F.col("row_count")).alias(n) for n in wanted],
    )
    return totals.filter(F.col("total_assets") > 0).orderBy(_desc("total_assets"), "symbol", "name")


def quarterly_trends(
    tables: Tables, revenue: str = REVENUE, net_income: str = NET_INCOME,
    parts: Sequence[str] = ("bs", "cf"), data_type: str | None = None,
) -> DataFrame:
    """Highest revenue and net income of each company beside each of its periods."""
    facts = filings.fact_groups(
        tables, [F.max(F.col("value").cast("double")).alias("value")], parts
    )
    if data_type is not None:
        facts = facts.filter(F.col("data_type") == data_type)
    per_symbol = facts.groupBy("symbol").agg(
        max_where("concept", revenue, "value").alias("revenue"),
        max_where("concept", net_income, "value").alias("net_income"),
    )
    periods = filings.financial_metadata(tables).select(
        "symbol", "name", "year", "quarter"
    ).distinct()
    return periods.join(per_symbol, "symbol").orderBy(
        _desc("year"), _desc("quarter"), "symbol", "name"
    )


# ---- statement tables ----------------------------------------------------

def balance_sheet_key_metrics(
    tables: Tables, concepts: Sequence[str] = KEY_BALANCE_CONCEPTS, k: int = 20
) -> DataFrame:
    """Average, highest and lowest value per company and concept."""
    rows = statements.balance_sheet(tables).filter(F.col("concept").isin(*concepts))
    return top_k(metric_stats(rows, ["symbol", "concept"]), [F.col("symbol"), F.col("concept")], k)


def _latest(rows: DataFrame, concepts: Sequence[str], k: int) -> DataFrame:
    kept = rows.filter(F.col("concept").isin(*concepts)).select(
        "symbol", "concept", "value", "filing_date", "label", "unit", "fiscal_year",
        "fiscal_period",
    )
    order = [_desc("filing_date"), *[F.col(c) for c in
             ("symbol", "concept", "value", "label", "unit", "fiscal_year", "fiscal_period")]]
    return top_k(kept, order, k).select("symbol", "concept", "value", "filing_date")


def income_statement_analysis(
    tables: Tables, concepts: Sequence[str] = INCOME_CONCEPTS, k: int = 20
) -> DataFrame:
    """Latest income-statement values."""
    return _latest(statements.income_statement(tables), concepts, k)


def cash_flow_indicators(
    tables: Tables, concepts: Sequence[str] = CASH_FLOW_TAGS, k: int = 20
) -> DataFrame:
    """Latest cash-flow values."""
    return _latest(statements.cash_flow(tables), concepts, k)


OVERVIEW_COLUMNS = (
    "company_symbol", "balance_metric", "income_metric", "cash_flow_metric",
    "balance_value", "income_value", "cash_flow_value",
)


def financial_overview(tables: Tables, k: int = 20) -> DataFrame:
    """Side-by-side metrics of the first companies."""
    rows = statements.fact_financials(tables).select(*OVERVIEW_COLUMNS)
    return top_k(rows, [F.col(c) for c in OVERVIEW_COLUMNS], k)


def health_indicators(
    tables: Tables, operating_cash_flow: str = OPERATING_CASH_FLOW, revenue: str = REVENUE,
    fan_out: bool = True, k: int | None = 15,
) -> DataFrame:
    """Companies by total assets, with liabilities, operating cash flow and revenue.

    With ``fan_out`` the sums are those of the three statement tables left-joined
    on the symbol, which repeats every row by the rows of the other tables. Here
    each sum is multiplied by those row counts. Without it each statement is
    summed by itself.
    """
    totals = statement_totals(tables, {
        "balance_sheet": {"total_assets": "Assets", "total_liabilities": "Liabilities"},
        "cash_flow": {"operating_cash_flow": operating_cash_flow},
        "income_statement": {"revenue": revenue},
    })
    bs, cf, inc = (F.greatest(F.col(f"n_{s}"), F.lit(1)).cast("double")
                   for s in ("balance_sheet", "cash_flow", "income_statement"))
    factor = {"total_assets": cf * inc, "total_liabilities": cf * inc,
              "operating_cash_flow": bs * inc, "revenue": bs * cf}
    columns = [
        (F.col(n).cast("double") * (f if fan_out else F.lit(1.0))).alias(n)
        for n, f in factor.items()
    ]
    rows = totals.filter(F.col("n_balance_sheet") > 0).select("symbol", *columns)
    order = [_desc("total_assets"), F.col("symbol")]
    return rows.orderBy(*order) if k is None else top_k(rows, order, k)


def statement_totals(
    tables: Tables, wanted: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Staging rows per statement and sums of chosen tags per company, from one pass over ``num``."""
    # A row counts once for every label of its tag: sums per tag first, then at most one row per listed tag.
    labels = F.broadcast(statements.label_counts(tables, *wanted))
    per_tag = statements.unlabelled(tables, *wanted).groupBy("company_symbol", "metric_code").agg(
        F.count("*").alias("n"), F.sum("metric_value").alias("value"))
    counted = per_tag.join(labels, "metric_code").select(
        "company_symbol", "metric_code", (F.col("n") * F.col("labels")).alias("n"),
        (F.col("value") * F.col("labels").cast("decimal(10,0)")).alias("value"))
    aggregates = []
    for statement, sums in wanted.items():
        tags = statements.statement_tags([statement])
        aggregates.append(F.coalesce(
            F.sum(F.when(F.col("metric_code").isin(*tags), F.col("n"))), F.lit(0)).alias(f"n_{statement}"))
        aggregates.extend(
            sum_where(F.col("metric_code") == tag, "value").alias(name)
            for name, tag in sums.items()
        )
    return counted.groupBy(F.col("company_symbol").alias("symbol")).agg(*aggregates)


QUERIES: dict[str, Callable[..., DataFrame]] = {
    "recent_filings": recent_filings,
    "top_companies": top_companies,
    "values_by_tag": values_by_tag,
    "tag_usage": tag_usage,
    "data_points": data_points,
    "balance_sheet_analysis": balance_sheet_analysis,
    "cash_flow_metrics": cash_flow_metrics,
    "company_health": company_health,
    "quarterly_trends": quarterly_trends,
    "balance_sheet_key_metrics": balance_sheet_key_metrics,
    "income_statement_analysis": income_statement_analysis,
    "cash_flow_indicators": cash_flow_indicators,
    "financial_overview": financial_overview,
    "health_indicators": health_indicators,
}


def named_query(name: str) -> Callable[..., DataFrame]:
    """The analyst query called ``name``: takes the tables and its parameters."""
    if name not in QUERIES:
        raise KeyError(f"no query {name!r}; known: {', '.join(QUERIES)}")
    return QUERIES[name]


def register_views(tables: Tables, prefix: str = "") -> None:
    """Offer tables to SQL as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def run_sql(spark: SparkSession, tables: Tables, text: str) -> DataFrame:
    """Ad-hoc SQL over the tables, in their session; the result is as wide and long as the text says."""
    register_views(tables)
    return next((df.sparkSession for df in tables.values()), spark).sql(text)
