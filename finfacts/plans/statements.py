"""Staging statements, the fact table, company metrics and statement tables.

``tables`` maps ``sub``, ``num`` and ``tag`` to raw DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finfacts.functions import (
    is_fiscal_period, norm_fiscal_period, norm_unit, safe_date, safe_decimal, statement_source,
)
from finfacts.operators.aggregates import max_where, pivot_metrics, with_ratios
from finfacts.operators.joins import join_filing, valid_companies
from finfacts.schema import (
    FISCAL_PERIODS, METRIC_COLUMNS, SOURCE_LABELS, STATEMENT_TAGS,
)

Tables = Mapping[str, DataFrame]

STAGING_COLUMNS = (
    "company_symbol", "filing_date", "fiscal_year", "fiscal_period", "metric_name",
    "metric_code", "metric_info", "measurement_unit", "metric_value", "source_file",
)
FACT_COLUMNS = (
    "company_symbol", "fiscal_year", "fiscal_period", "filing_date", "metric_name",
    "metric_value", "metric_code", "measurement_unit", "source_file",
)
METRIC_KEYS = ("company_symbol", "fiscal_year", "fiscal_period", "filing_date")


def statement_tags(statements: Sequence[str]) -> list[str]:
    """Tags of the named statements."""
    return [tag for s in statements for tag in STATEMENT_TAGS[s]]


def filter_statement(num: DataFrame, statements: Sequence[str]) -> DataFrame:
    """Reported values of the statements' tags, without NULL values."""
    return num.filter(
        F.col("tag").isin(*statement_tags(statements)) & F.col("value").isNotNull()
    )


def _numbers(num: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Parsed values of the given tags; both filters sit next to the scan, a text that is no number is NULL."""
    return num.filter(F.col("tag").isin(*tags) & F.col("value").isNotNull()).select(
        "adsh", F.col("tag").alias("metric_code"),
        norm_unit(F.col("uom")).alias("measurement_unit"),
        safe_decimal(F.col("value")).alias("metric_value"),
    )


def _filings(sub: DataFrame, complete_only: bool = False) -> DataFrame:
    """Filing header in the shape of the staging statements.

    ``complete_only`` applies the guards of the fact table to the raw columns.
    """
    kept = F.col("cik").isNotNull()
    if complete_only:
        kept = (
            kept & F.col("fy").isNotNull() & is_fiscal_period(F.col("fp"))
            & safe_date(F.col("period")).isNotNull()
        )
    return sub.filter(kept).select(
        "adsh", F.col("cik").alias("company_symbol"), F.col("period").alias("filing_date"),
        F.col("fy").alias("fiscal_year"),
        norm_fiscal_period(F.col("fp")).alias("fiscal_period"),
    )


def _staged(tables: Tables, statements: Sequence[str], complete_only: bool) -> DataFrame:
    """Distinct staging rows of several statements from a single pass over ``num``.

    The rows are made distinct before the labels of the tag dictionary are
    joined. Every dropped column is kept on one of the two distinct inputs, so
    the result is distinct again and the label fan-out is never shuffled.
    """
    rows = _unlabelled(tables, statements, complete_only).join(_labels(tables, statements), "metric_code")
    return rows.withColumn("source_file", statement_source(F.col("metric_code"))).select(
        *STAGING_COLUMNS
    )


def _unlabelled(tables: Tables, statements: Sequence[str], complete_only: bool) -> DataFrame:
    filings = _filings(tables["sub"], complete_only)
    values = _numbers(tables["num"], statement_tags(statements)).filter(F.col("metric_value").isNotNull())
    return join_filing(values, filings).drop("adsh").distinct()


def _labels(tables: Tables, statements: Sequence[str]) -> DataFrame:
    return tables["tag"].filter(F.col("tag").isin(*statement_tags(statements))).select(
        F.col("tag").alias("metric_code"), F.col("tlabel").alias("metric_name"),
        F.col("datatype").alias("metric_info"),
    ).distinct()


def unlabelled(tables: Tables, *statements: str) -> DataFrame:
    """Staging rows of the named statements before the labels of their tags are joined."""
    return _unlabelled(tables, statements, complete_only=False)


def label_counts(tables: Tables, *statements: str) -> DataFrame:
    """``labels``, how often the tag dictionary repeats a staging row of a tag; one row per listed tag at most."""
    return _labels(tables, statements).groupBy("metric_code").agg(F.count("*").alias("labels"))


def staging(tables: Tables, *statements: str) -> DataFrame:
    """Staging rows of the named statements, by default of all three."""
    return _staged(tables, statements or tuple(STATEMENT_TAGS), complete_only=False)


def stg_balance_sheet(tables: Tables) -> DataFrame:
    """Staging rows of the balance sheet."""
    return staging(tables, "balance_sheet")


def stg_income_statement(tables: Tables) -> DataFrame:
    """Staging rows of the income statement."""
    return staging(tables, "income_statement")


def stg_cash_flow(tables: Tables) -> DataFrame:
    """Staging rows of the cash-flow statement."""
    return staging(tables, "cash_flow")


def _dated(staged: DataFrame) -> DataFrame:
    """Staging rows as facts, with the filing date parsed."""
    return staged.withColumn("filing_date", safe_date(F.col("filing_date"))).select(*FACT_COLUMNS)


def fact_guards() -> Column:
    """True for the staging rows that become facts."""
    return (
        F.col("company_symbol").isNotNull() & F.col("metric_value").isNotNull()
        & safe_date(F.col("filing_date")).isNotNull() & F.col("fiscal_year").isNotNull()
        & F.col("fiscal_period").isin(*FISCAL_PERIODS)
    )


def facts_of_filings(staged: DataFrame) -> DataFrame:
    """Facts of staging rows whose companies all come from ``sub``."""
    return _dated(staged.filter(fact_guards()))


def facts_from_staging(staged: DataFrame, sub: DataFrame) -> DataFrame:
    """Guard stored staging rows, keep the companies of ``sub`` and parse the filing date."""
    return facts_of_filings(valid_companies(staged, sub))


def fct_financial_statements(tables: Tables, load_time: bool = False) -> DataFrame:
    """Fact table over the three statements.

    Its company check needs no join: every row takes its company from ``sub``.
    """
    facts = _dated(_staged(tables, tuple(STATEMENT_TAGS), complete_only=True))
    return facts.withColumn("dbt_loaded_at", F.current_timestamp()) if load_time else facts


def company_metrics_from_facts(facts: DataFrame) -> DataFrame:
    """Twelve metrics and eight ratios per company and period, out of a stored fact table."""
    return with_ratios(pivot_metrics(facts, METRIC_KEYS))


def known_tags(tag: DataFrame) -> DataFrame:
    """The statement tags that the tag dictionary holds: at most one row for each."""
    return tag.filter(F.col("tag").isin(*statement_tags(tuple(STATEMENT_TAGS)))).select("tag").distinct()


def _per_filing(tables: Tables, columns: Mapping[str, str], known_only: bool = True) -> DataFrame:
    """Maximum of each metric within a filing, one row per filing with any statement value.

    A maximum ignores duplicates and labels, so neither the distinct rows nor the
    label join of the staging statements are needed. ``num`` is reduced before
    its only shuffle; a filing that holds most rows sends one row per task. Without
    ``known_only`` tags count that the dictionary lacks.
    """
    values = _numbers(tables["num"], statement_tags(tuple(STATEMENT_TAGS)))
    if known_only:
        # At most one row per listed tag.
        known = F.broadcast(known_tags(tables["tag"]).select(F.col("tag").alias("metric_code")))
        values = values.join(known, "metric_code", "left_semi")
    pivoted = values.groupBy("adsh").agg(
        F.count("metric_value").alias("_values"),
        *[max_where("metric_code", tag, "metric_value").alias(name)
          for name, tag in columns.items()],
    )
    return pivoted.filter(F.col("_values") > 0).drop("_values")


def metric_maxima(tables: Tables, columns: Mapping[str, str], known_only: bool = True) -> DataFrame:
    """Maximum of each metric per company and period, out of the raw tables."""
    filings = _filings(tables["sub"], complete_only=True).withColumn(
        "filing_date", safe_date(F.col("filing_date"))
    )
    joined = join_filing(_per_filing(tables, columns, known_only), filings)
    return joined.groupBy(*METRIC_KEYS).agg(*[F.max(name).alias(name) for name in columns])


def company_metrics(tables: Tables) -> DataFrame:
    """Twelve metrics and eight ratios per company and period, out of the raw tables."""
    return with_ratios(metric_maxima(tables, METRIC_COLUMNS))


STATEMENT_KEY = (
    "company_symbol", "filing_date", "fiscal_year", "fiscal_period", "metric_code",
    "metric_name", "metric_info", "measurement_unit", "metric_value",
)


def statement_table(tables: Tables, statement: str, loaded: bool = False) -> DataFrame:
    """Statement rows under their analyst names; ``loaded`` adds the id and the load time."""
    return analyst_rows(staging(tables, statement), loaded)


def analyst_rows(staged: DataFrame, loaded: bool = False) -> DataFrame:
    """Staging rows, stored ones too, under their analyst names."""
    table = staged.select(
        F.col("company_symbol").alias("symbol"), F.col("metric_name").alias("label"),
        F.col("metric_code").alias("concept"), F.col("metric_info").alias("info"),
        F.col("measurement_unit").alias("unit"),
        F.col("metric_value").cast("double").alias("value"),
        F.col("source_file").alias("file_name"), "filing_date", "fiscal_year",
        "fiscal_period",
        *([F.xxhash64(*STATEMENT_KEY).alias("id")] if loaded else []),
    )
    return table.withColumn("loaded_at", F.current_timestamp()) if loaded else table


def balance_sheet(tables: Tables, loaded: bool = False) -> DataFrame:
    """Balance-sheet table."""
    return statement_table(tables, "balance_sheet", loaded)


def income_statement(tables: Tables, loaded: bool = False) -> DataFrame:
    """Income-statement table."""
    return statement_table(tables, "income_statement", loaded)


def cash_flow(tables: Tables, loaded: bool = False) -> DataFrame:
    """Cash-flow table."""
    return statement_table(tables, "cash_flow", loaded)


def fact_financials(tables: Tables, loaded: bool = False) -> DataFrame:
    """Balance, income and cash-flow metrics of a company and period side by side.

    Each side holds the maximum per metric. The sides are three short arrays,
    bounded by the tag lists, so one grouping replaces two joins.
    """
    columns = {f"_{i}": tag for i, tag in enumerate(statement_tags(tuple(STATEMENT_TAGS)))}
    keyed = _filings(tables["sub"]).dropna(
        subset=["filing_date", "fiscal_year", "fiscal_period"]
    )
    grouped = join_filing(_per_filing(tables, columns), keyed).groupBy(*METRIC_KEYS).agg(
        *[F.max(name).alias(name) for name in columns]
    )
    return _side_by_side(grouped, columns, loaded)


def fact_financials_from_staging(staged: DataFrame, loaded: bool = False) -> DataFrame:
    """The same table out of stored staging rows."""
    columns = {f"_{i}": tag for i, tag in enumerate(statement_tags(tuple(STATEMENT_TAGS)))}
    grouped = staged.dropna(subset=list(METRIC_KEYS)).groupBy(*METRIC_KEYS).agg(*[
        max_where("metric_code", tag, "metric_value").alias(name) for name, tag in columns.items()
    ])
    return _side_by_side(grouped, columns, loaded)


def _side_by_side(grouped: DataFrame, columns: Mapping[str, str], loaded: bool) -> DataFrame:
    names = {tag: name for name, tag in columns.items()}

    def side(statement: str) -> Column:
        entries = F.array(*[
            F.struct(F.lit(t).alias("metric"), F.col(names[t]).cast("double").alias("value"))
            for t in STATEMENT_TAGS[statement]
        ])
        return F.explode(F.filter(entries, lambda e: e["value"].isNotNull()))

    sides = (
        grouped.withColumn("_b", side("balance_sheet"))
        .withColumn("_i", side("income_statement"))
        .withColumn("_c", side("cash_flow"))
    )
    table = sides.select(
        *METRIC_KEYS,
        F.col("_b.metric").alias("balance_metric"), F.col("_i.metric").alias("income_metric"),
        F.col("_c.metric").alias("cash_flow_metric"),
        F.col("_b.value").alias("balance_value"), F.col("_i.value").alias("income_value"),
        F.col("_c.value").alias("cash_flow_value"),
    )
    return table.withColumn("loaded_at", F.current_timestamp()) if loaded else table
