"""Units, numbers and ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from finfacts.schema import DEFAULT_UNIT, SOURCE_LABELS, STATEMENT_TAGS, UNIT_SPELLINGS


def norm_unit(unit: Column) -> Column:
    """Map unit spellings to USD, shares, ratio or percent; anything else is USD."""
    key = F.upper(F.trim(unit))
    out = F.when(F.lit(False), F.lit(DEFAULT_UNIT))
    for name, spellings in UNIT_SPELLINGS.items():
        out = out.when(key.isin(*spellings), F.lit(name))
    return out.otherwise(F.lit(DEFAULT_UNIT))


def safe_decimal(text: Column) -> Column:
    """Decimal with four places, NULL if the text is no number."""
    return text.try_cast("decimal(38,4)")


def doc_value(text: Column, exact: bool = False) -> Column:
    """Value of a document fact: truncated toward zero, or kept with ``exact``."""
    number = text.try_cast("decimal(28,4)")
    return number if exact else number.try_cast("bigint")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double where the denominator is positive; NULL otherwise."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    )


def statement_source(tag: Column) -> Column:
    """Provenance label of the statement a tag belongs to."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for statement, tags in STATEMENT_TAGS.items():
        out = out.when(tag.isin(*tags), F.lit(SOURCE_LABELS[statement]))
    return out
