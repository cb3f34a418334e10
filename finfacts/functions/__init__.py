"""Column functions: every one maps Columns to a Column and stays in codegen."""

from finfacts.functions.periods import (
    doc_quarter, doc_year, is_fiscal_period, norm_fiscal_period, parse_period, period_end,
    period_key, safe_date, safe_year,
)
from finfacts.functions.text import (
    clean_text, doc_field, last_path_segment, norm_symbol, route_stmt, strip,
)
from finfacts.functions.values import (
    doc_value, norm_unit, safe_decimal, safe_ratio, statement_source,
)

__all__ = [
    "clean_text", "doc_field", "doc_quarter", "doc_value", "doc_year", "is_fiscal_period",
    "last_path_segment", "norm_fiscal_period", "norm_symbol", "norm_unit",
    "parse_period", "period_end", "period_key", "route_stmt", "safe_date",
    "safe_decimal", "safe_ratio", "safe_year", "statement_source", "strip",
]
