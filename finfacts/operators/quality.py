"""Data-quality checks: one row per check, a check passes at zero failures.

All single-table checks of a table are folded into one aggregate, so each table
is read once however many checks it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """A named rule about one column; ``failing`` is true on the rows that break it."""

    check: str
    column: str
    failing: Column
    table: str | None = None


def _scoped(failing: Column, where: Column | None) -> Column:
    return failing if where is None else (where & failing)


def not_null(column: str, where: Column | None = None, table: str | None = None) -> Check:
    """The column is never NULL."""
    return Check("not_null", column, _scoped(F.col(column).isNull(), where), table)


def accepted_values(
    column: str, values: Sequence[str], where: Column | None = None, table: str | None = None
) -> Check:
    """The column holds listed values; NULL is not judged."""
    return Check("accepted_values", column, _scoped(~F.col(column).isin(*values), where), table)


def expression_is_true(
    name: str, condition: Column, where: Column | None = None, table: str | None = None
) -> Check:
    """The condition holds; NULL is not judged."""
    return Check("expression_is_true", name, _scoped(~condition, where), table)


def accepted_range(
    column: str, low, high, where: Column | None = None, table: str | None = None
) -> Check:
    """The column lies between two bounds; NULL is not judged."""
    return Check(
        "accepted_range", column, _scoped(~F.col(column).between(low, high), where), table
    )


def not_empty(column: str, where: Column | None = None, table: str | None = None) -> Check:
    """The text is not empty after trimming."""
    return Check("not_empty", column, _scoped(F.trim(F.col(column)) == "", where), table)


def check_table(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Failures of all checks of a table, from a single pass."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"_c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.check).alias("check"), F.lit(c.table or table).alias("table"),
            F.lit(c.column).alias("column"), F.col(f"_c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _report(failures: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        F.lit(column).alias("column"), "failures",
    )


def relationship(
    child: DataFrame, column: str, parent: DataFrame, key: str, table: str
) -> DataFrame:
    """Child rows whose key is missing in the parent; NULL keys are not judged.

    Rows are counted per key before the anti join, so a hot key costs one row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(
        F.count("*").alias("_rows")
    )
    known = parent.select(F.col(key).alias("_key")).distinct()
    missing = keys.join(known, "_key", "left_anti")
    failures = missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures"))
    return _report(failures, "relationship", table, column)


def unique(df: DataFrame, column: str, table: str) -> DataFrame:
    """Number of values that occur more than once."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return _report(repeated.agg(F.count("*").alias("failures")), "unique", table, column)
