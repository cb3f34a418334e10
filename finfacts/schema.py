"""Declared schemas and the fixed vocabularies of the filing data set."""

from __future__ import annotations

# --------------------------------------------------------------------------
# Column names of the raw tables, in file order.
# --------------------------------------------------------------------------
SUB_COLUMNS = (
    "adsh", "cik", "name", "sic",
    "countryba", "stprba", "cityba", "zipba", "bas1", "bas2", "baph",
    "countryma", "stprma", "cityma", "zipma", "mas1", "mas2",
    "countryinc", "stprinc", "ein", "former", "changed", "afs", "wksi",
    "fye", "form", "period", "fy", "fp", "filed", "accepted", "prevrpt",
    "detail", "instance", "nciks", "aciks",
)
NUM_COLUMNS = (
    "adsh", "tag", "version", "ddate", "qtrs", "uom", "segments", "coreg",
    "value", "footnote",
)
TAG_COLUMNS = (
    "tag", "version", "custom", "abstract", "datatype", "iord", "crdr",
    "tlabel", "doc",
)
PRE_COLUMNS = (
    "adsh", "report", "line", "stmt", "inpth", "rfile", "tag", "version",
    "plabel", "negating",
)

RAW_COLUMNS = {
    "sub": SUB_COLUMNS, "num": NUM_COLUMNS, "tag": TAG_COLUMNS, "pre": PRE_COLUMNS,
}

# Columns that must be present in every loaded row.
REQUIRED_COLUMNS = {
    "sub": (),
    "num": ("adsh", "tag", "version", "ddate", "qtrs", "uom"),
    "tag": ("tag", "version", "custom", "abstract"),
    "pre": (),
}

# Columns whose typed form is not a string.
TYPED_COLUMNS = {
    "sub": {},
    "num": {"ddate": "date", "qtrs": "int", "value": "decimal(28,4)"},
    "tag": {"custom": "boolean", "abstract": "boolean"},
    "pre": {"report": "int", "line": "int", "inpth": "int", "negating": "int"},
}

# --------------------------------------------------------------------------
# Statement tags and the provenance label of each statement.
# --------------------------------------------------------------------------
BALANCE_SHEET_TAGS = (
    "Assets",
    "Liabilities",
    "StockholdersEquity",
    "CashAndCashEquivalents",
    "AccountsReceivable",
    "Inventory",
)
INCOME_STATEMENT_TAGS = (
    "OperatingIncomeLoss",
    "NetIncomeLoss",
    "EarningsPerShareBasic",
    "EarningsPerShareDiluted",
    "Revenues",
    "CostOfRevenue",
)
CASH_FLOW_TAGS = (
    "NetCashProvidedByUsedInFinancingActivities",
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInInvestingActivities",
)
STATEMENT_TAGS = {
    "balance_sheet": BALANCE_SHEET_TAGS,
    "income_statement": INCOME_STATEMENT_TAGS,
    "cash_flow": CASH_FLOW_TAGS,
}
SOURCE_LABELS = {
    "balance_sheet": "SEC_BALANCE_SHEET",
    "income_statement": "SEC_INCOME_STATEMENT",
    "cash_flow": "SEC_CASH_FLOW",
}

# --------------------------------------------------------------------------
# Spellings of fiscal periods and of measurement units.
# --------------------------------------------------------------------------
FISCAL_PERIOD_SPELLINGS = {
    "Q1": ("Q1", "QTR1", "QUARTER1", "1", "1ST", "FIRST"),
    "Q2": ("Q2", "QTR2", "QUARTER2", "2", "2ND", "SECOND"),
    "Q3": ("Q3", "QTR3", "QUARTER3", "3", "3RD", "THIRD"),
    "Q4": ("Q4", "QTR4", "QUARTER4", "4", "4TH", "FOURTH"),
    "FY": ("FY", "YEAR", "ANNUAL", "Y", "YEARLY"),
}
FISCAL_PERIODS = tuple(FISCAL_PERIOD_SPELLINGS)
UNIT_SPELLINGS = {
    "USD": ("USD", "DOLLARS", "$"),
    "shares": ("SHARES", "SHS", "SHARE"),
    "ratio": ("RATIO", "R"),
    "percent": ("PERCENT", "%", "PCT"),
}
DEFAULT_UNIT = "USD"

# Length in months of the period codes a document may carry.
PERIOD_MONTHS = {
    12: ("FY", "CY"),
    6: ("H1", "H2"),
    4: ("T1", "T2", "T3"),
    3: ("Q1", "Q2", "Q3", "Q4"),
}
# Statement codes routed into a document, and symbol length.
DOCUMENT_PARTS = ("bs", "cf", "ic")
LOADED_PARTS = ("bs", "cf")
SYMBOL_MIN_LENGTH, SYMBOL_MAX_LENGTH = 1, 19
# Date guard of the fact table, first year of the data set.
MIN_DATE, MAX_DATE = "1900-01-01", "2100-01-01"
FIRST_YEAR = 2009

# --------------------------------------------------------------------------
# Output column of each pivoted metric, and the ratios.
# --------------------------------------------------------------------------
METRIC_COLUMNS = {
    "total_assets": "Assets",
    "total_liabilities": "Liabilities",
    "stockholders_equity": "StockholdersEquity",
    "cash_and_equivalents": "CashAndCashEquivalents",
    "revenue": "Revenues",
    "cost_of_revenue": "CostOfRevenue",
    "operating_income": "OperatingIncomeLoss",
    "net_income": "NetIncomeLoss",
    "eps_basic": "EarningsPerShareBasic",
    "operating_cash_flow": "NetCashProvidedByUsedInOperatingActivities",
    "investing_cash_flow": "NetCashProvidedByUsedInInvestingActivities",
    "financing_cash_flow": "NetCashProvidedByUsedInFinancingActivities",
}
# ratio -> (numerator, denominator)
RATIO_COLUMNS = {
    "cash_ratio": ("cash_and_equivalents", "total_assets"),
    "gross_margin": ("revenue - cost_of_revenue", "revenue"),
    "net_profit_margin": ("net_income", "revenue"),
    "return_on_assets": ("net_income", "total_assets"),
    "return_on_equity": ("net_income", "stockholders_equity"),
    "debt_to_equity": ("total_liabilities", "stockholders_equity"),
    "debt_ratio": ("total_liabilities", "total_assets"),
    "operating_cash_flow_ratio": ("operating_cash_flow", "net_income"),
}


def raw_schema(table: str) -> str:
    """All-string schema of a raw table."""
    return ", ".join(f"`{c}` string" for c in RAW_COLUMNS[table])


def typed_schema(table: str) -> str:
    """Schema of a raw table after the typed projection."""
    kinds = TYPED_COLUMNS[table]
    return ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in RAW_COLUMNS[table])


TICKER_SCHEMA = "symbol string, cik string"

# Header fields of a filing document, in order.
DOC_HEADER = (
    "startDate", "endDate", "year", "quarter", "symbol", "name", "country", "city",
)


def document_schema(exact: bool = False) -> str:
    """Schema of one filing document; ``exact`` keeps decimal values.

    """
    value = "decimal(28,4)" if exact else "bigint"
    fact = f"struct<label:string,concept:string,info:string,unit:string,value:{value}>"
    parts = ", ".join(f"{p}: array<{fact}>" for p in DOCUMENT_PARTS)
    return (
        "startDate date, endDate date, year int, quarter string, symbol string, "
        f"name string, country string, city string, data struct<{parts}>"
    )


DOC_SCHEMA = document_schema()
