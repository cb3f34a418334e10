"""The declared data tests of the raw tables, the staging statements and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finfacts.functions import safe_date
from finfacts.operators import quality as Q
from finfacts.operators.aggregates import union_all
from finfacts.plans import statements as S
from finfacts.schema import FISCAL_PERIODS, MAX_DATE, MIN_DATE, SOURCE_LABELS

# Columns declared as not null.
SOURCE_NOT_NULL = {
    "pre": ("adsh", "report", "line"),
    "num": ("adsh", "tag"),
    "sub": ("adsh", "cik"),
    "tag": ("tag",),
}
FACT_NOT_NULL = ("company_symbol", "fiscal_year", "fiscal_period", "filing_date", "metric_value")
METRICS_NOT_NULL = ("company_symbol", "fiscal_year", "fiscal_period")


def source_checks(tables: S.Tables) -> DataFrame:
    """Checks of the raw tables, one pass each."""
    reports = []
    for table, columns in SOURCE_NOT_NULL.items():
        checks = [Q.not_null(c) for c in columns]
        if table == "num":
            reported = ~F.col("tag").isin("text_only_tags") & F.col("value").isNotNull()
            checks.append(Q.not_null("value", reported))
        reports.append(Q.check_table(tables[table], table, checks))
    return union_all(*reports)


def statement_checks(tables: S.Tables) -> DataFrame:
    """Checks of the staging statements, the fact table and the company metrics.

    The three read one staging plan, which Spark computes once. Facts are its rows that
    pass the guards, and all counts are taken per company before they meet the filings.
    """
    staged = S.staging(tables)
    guarded = S.fact_guards()
    checks = []
    for statement, label in SOURCE_LABELS.items():
        own = F.col("source_file") == label
        name = f"stg_{statement}"
        checks.append(Q.not_null("company_symbol", own, name))
        checks.append(Q.accepted_values(
            "fiscal_period", FISCAL_PERIODS, own & F.col("fiscal_period").isNotNull(), name
        ))
    fact = "fct_financial_statements"
    checks += [Q.not_null(c, guarded, fact) for c in FACT_NOT_NULL if c != "filing_date"]
    day = safe_date(F.col("filing_date"))
    checks.append(Q.Check("not_null", "filing_date", guarded & day.isNull(), fact))
    checks.append(Q.accepted_values("fiscal_period", FISCAL_PERIODS, guarded, fact))
    checks.append(Q.expression_is_true("filing_date", day.between(MIN_DATE, MAX_DATE), guarded, fact))
    facts = S.facts_of_filings(staged)
    metric_rules = [Q.not_null(c) for c in METRICS_NOT_NULL]
    metric_rules.append(Q.accepted_values("fiscal_period", FISCAL_PERIODS))
    return union_all(
        Q.check_table(staged, "staging", checks),
        Q.relationship(facts, "company_symbol", tables["sub"], "cik", fact),
        Q.check_table(S.company_metrics_from_facts(facts), "company_metrics", metric_rules),
    )


def all_checks(tables: S.Tables) -> DataFrame:
    """Every declared check with its number of failures."""
    return union_all(source_checks(tables), statement_checks(tables))
