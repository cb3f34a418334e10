"""Grouped counts, pivots, conditional totals and row dedup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finfacts.functions import safe_ratio
from finfacts.schema import FISCAL_PERIODS, METRIC_COLUMNS, RATIO_COLUMNS

EXACT = "decimal(38,4)"


def count_by(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def metric_stats(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Average, maximum and minimum per group.

    The average divides an exact sum, so it does not depend on the row order.
    """
    total = F.sum(F.col(value).cast(EXACT)).cast("double")
    return df.groupBy(*keys).agg(
        (total / F.count(value)).alias("avg_value"), F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
    )


def max_where(code: str, wanted: str, value: str) -> Column:
    """Maximum of ``value`` over the rows whose ``code`` is ``wanted``."""
    return F.max(F.when(F.col(code) == wanted, F.col(value)))


def pivot_metrics(
    facts: DataFrame, keys: Sequence[str], code: str = "metric_code",
    value: str = "metric_value", columns: Mapping[str, str] = METRIC_COLUMNS,
) -> DataFrame:
    """One column per metric: the maximum value of its code within the group."""
    return facts.groupBy(*keys).agg(
        *[max_where(code, tag, value).alias(name) for name, tag in columns.items()]
    )


def with_ratios(metrics: DataFrame) -> DataFrame:
    """Append the financial ratios to pivoted metrics."""
    ratios = {
        name: safe_ratio(F.expr(numerator), F.col(denominator))
        for name, (numerator, denominator) in RATIO_COLUMNS.items()
    }
    return metrics.withColumns(ratios)


def sum_where(condition: Column, value: str = "value") -> Column:
    """Exact sum of ``value`` over the rows meeting ``condition``; 0 if none does."""
    return F.sum(
        F.when(condition, F.col(value).cast(EXACT)).otherwise(F.lit(0).cast(EXACT))
    )


def conditional_totals(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column], value: str = "value"
) -> DataFrame:
    """Conditional sums per group."""
    return df.groupBy(*keys).agg(
        *[sum_where(condition, value).alias(name) for name, condition in totals.items()]
    )


def invalid_fiscal_periods(df: DataFrame, column: str = "fiscal_period") -> DataFrame:
    """Period codes outside Q1..Q4 and FY with their counts; NULL is not reported."""
    bad = df.filter(~F.col(column).isin(*FISCAL_PERIODS))
    return count_by(bad, [column], "record_count")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, one row each."""
    return _union([
        df.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table"), "row_count")
        for name, df in tables.items()
    ])


def load_counts(meta: DataFrame, data: DataFrame) -> DataFrame:
    """Records and distinct symbols of the two document tables.

    Symbols are counted per group first: no distinct list meets in one task.
    """
    reports = []
    for title, df in (("Metadata Count", meta), ("Financial Data Count", data)):
        per_symbol = count_by(df, ["symbol"])
        reports.append(per_symbol.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("record_count"),
            F.count("symbol").alias("unique_symbols"),
        ).select(F.lit(title).alias("check_type"), "record_count", "unique_symbols"))
    return _union(reports)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name, keeping duplicates."""
    return _union(frames)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows in ``order``: one heap per task, then a merge."""
    return df.orderBy(*order).limit(k)
