"""Text cleaning, routing and path access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from finfacts.schema import DOCUMENT_PARTS, SYMBOL_MAX_LENGTH, SYMBOL_MIN_LENGTH


WHITE_SPACE = " \t\n\r\f\v"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of every kind (``trim`` removes spaces only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def clean_text(text: Column, label: bool = False) -> Column:
    """Drop carriage returns and turn line feeds into spaces; labels lose double quotes."""
    cleaned = F.replace(F.replace(text, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" "))
    return F.replace(cleaned, F.lit('"'), F.lit("'")) if label else cleaned


def norm_symbol(symbol: Column) -> Column:
    """Ticker in upper case; NULL if its length is out of range."""
    ticker = F.upper(strip(symbol))
    return F.when(
        F.length(ticker).between(SYMBOL_MIN_LENGTH, SYMBOL_MAX_LENGTH), ticker
    )


def route_stmt(stmt: Column, parts: Sequence[str] = DOCUMENT_PARTS) -> Column:
    """Document part of a statement code; NULL for codes that are not routed."""
    code = strip(stmt)
    return F.when(code.isin(*[p.upper() for p in parts]), F.lower(code))


def doc_field(document: Column, path: str, kind: str) -> Column:
    """Value at ``path`` of a variant document, cast to ``kind``; NULL if it does not fit."""
    return F.try_variant_get(document, f"$.{path}", kind)


def last_path_segment(url: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(url, "/", -1)
