"""Fiscal periods, dates and period keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from finfacts.functions.text import strip
from finfacts.schema import (
    FISCAL_PERIOD_SPELLINGS, MAX_DATE, MIN_DATE, PERIOD_MONTHS,
)


def norm_fiscal_period(code: Column, keep_unknown: bool = False) -> Column:
    """Map the spellings of a fiscal period to Q1..Q4 or FY.

    Unknown codes become NULL, or pass through with ``keep_unknown``.
    """
    key = F.upper(F.trim(code))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for period, spellings in FISCAL_PERIOD_SPELLINGS.items():
        out = out.when(key.isin(*spellings), F.lit(period))
    return out.otherwise(code) if keep_unknown else out


def is_fiscal_period(code: Column) -> Column:
    """True if the code is a known spelling; the test evaluates the code once."""
    known = [s for spellings in FISCAL_PERIOD_SPELLINGS.values() for s in spellings]
    return F.upper(F.trim(code)).isin(*known)


def _is_digits8(text: Column) -> Column:
    return text.rlike("^[0-9]{8}$")


def _digits_date(text: Column) -> Column:
    """Date of eight digits through the plain date cast, which needs no formatter object."""
    return F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    ).try_cast("date")


def parse_period(code: Column) -> Column:
    """Date of an 8-digit ``yyyyMMdd`` code; NULL for any other text."""
    return F.when(_is_digits8(code), _digits_date(code))


def safe_date(text: Column) -> Column:
    """Parsed date between the guard dates; NULL otherwise.

    Eight digits are compared with the bounds as text, so they are parsed once.
    """
    low, high = MIN_DATE.replace("-", ""), MAX_DATE.replace("-", "")
    day = text.try_cast("date")
    bounds = F.to_date(F.lit(MIN_DATE)), F.to_date(F.lit(MAX_DATE))
    return F.when(
        _is_digits8(text), F.when(text.between(low, high), _digits_date(text))
    ).when(day.between(*bounds), day)


def safe_year(text: Column) -> Column:
    """Fiscal year of a digits-only text; NULL otherwise."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike("^[0-9]+$"), trimmed.try_cast("int"))


def doc_year(text: Column) -> Column:
    """Fiscal year of a document: a missing year is 0, a malformed one NULL."""
    return F.when(text.isNull(), F.lit(0)).otherwise(text.try_cast("int"))


def doc_quarter(code: Column) -> Column:
    """Period code of a document: stripped of white space, upper case."""
    return F.upper(strip(code))


def period_end(start: Column, code: Column) -> Column:
    """Last day of a period that begins at ``start``; NULL for unknown codes."""
    months = F.when(F.lit(False), F.lit(None).cast("int"))
    for length, codes in PERIOD_MONTHS.items():
        months = months.when(code.isin(*codes), F.lit(length))
    return F.date_sub(F.add_months(start, months), 1)


def period_key(
    year: Column, quarter: Column, first_year: int = 2000, last_year: int = 2100
) -> Column:
    """Folder key such as ``2020q1``; NULL for a year or quarter out of range."""
    valid = year.between(first_year, last_year) & quarter.isin("Q1", "Q2", "Q3", "Q4")
    return F.when(valid, F.concat(year.cast("string"), F.lower(quarter)))
