"""Check SQL in the dialect of the check engine, written from the definitions.

``TABLES`` mirrors the mapping of ``tables.py``; the models below follow the
plain definition (one join after the other, ``SELECT DISTINCT``, window ranks)
and not the plans of the library.
"""

from __future__ import annotations

import re

from finfacts.fixtures.tables import TAG_DIMENSION
from finfacts.schema import (
    FISCAL_PERIOD_SPELLINGS, METRIC_COLUMNS, PERIOD_MONTHS, RATIO_COLUMNS,
    SOURCE_LABELS, STATEMENT_TAGS, UNIT_SPELLINGS,
)


def text_list(values) -> str:
    """Quoted list for ``IN``."""
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_TAGDIM = ", ".join(f"({i}, '{t}', '{s}')" for i, (t, s) in enumerate(TAG_DIMENSION))

_TABLES = {
    "tagdim": f"SELECT * FROM (VALUES {_TAGDIM}) v(tid, tag, stmt)",
    "sub": """
 SELECT lpad(CAST(o_orderkey AS varchar), 18, '0') adsh,
  CAST(o_custkey AS varchar) cik, c_name AS name, n_name countryma, c_mktsegment cityma,
  CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '8-K' END form,
  CASE WHEN o_orderkey % 97 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y%m%d') END AS period,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS varchar) END fy,
  CASE o_orderkey % 9 WHEN 0 THEN 'Q1' WHEN 1 THEN ' qtr2 ' WHEN 2 THEN '3RD'
   WHEN 3 THEN 'fourth' WHEN 4 THEN 'FY' WHEN 5 THEN 'H1' WHEN 7 THEN 'annual'
   WHEN 8 THEN 'q4' END fp,
  strftime(o_orderdate + INTERVAL 30 DAY, '%Y%m%d') filed
 FROM orders JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey""",
    "num": """
 SELECT lpad(CAST(l_orderkey AS varchar), 18, '0') adsh, t.tag,
  'us-gaap/2022' AS version, strftime(l_shipdate, '%Y%m%d') ddate,
  CAST(l_linenumber % 5 AS varchar) qtrs,
  CASE l_linenumber % 6 WHEN 0 THEN 'USD' WHEN 1 THEN ' usd ' WHEN 2 THEN '$'
   WHEN 3 THEN 'Shares' WHEN 4 THEN 'pct' ELSE 'EUR' END uom,
  CASE WHEN l_suppkey % 10 = 3 AND l_linenumber = 1 THEN NULL
   WHEN l_suppkey % 10 = 4 AND l_linenumber = 2 THEN 'n/a'
   ELSE CAST(CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice
     ELSE l_extendedprice END AS decimal(28,4)) AS varchar) END AS value
 FROM lineitem JOIN tagdim t ON t.tid = l_partkey % 18""",
    "tag": """
 SELECT tag, 'us-gaap/' || v AS version, CASE WHEN tag LIKE 'Custom%' THEN '1' ELSE '0' END AS custom,
  '0' AS abstract, 'monetary' datatype, CASE stmt WHEN 'BS' THEN 'I' ELSE 'D' END iord,
  tag || ' ' || CASE v WHEN '2022' THEN lower(kind) ELSE 'v2' END tlabel, 'Doc of ' || pname || ' ' || v AS doc
 FROM tagdim JOIN (SELECT p_partkey % 18 tid, min(p_type) kind, min(p_name) pname FROM part GROUP BY 1) p USING (tid)
 JOIN (VALUES ('2022'), ('2023')) w(v) ON v = '2022' OR tid % 5 = 0
 WHERE tag <> 'UnlistedTag'
 UNION ALL
 SELECT 'Own' || p_partkey, p_brand, '1', '0', 'monetary', 'D', p_type, p_name FROM part""",
    "pre": """
 SELECT DISTINCT lpad(CAST(l_orderkey AS varchar), 18, '0') adsh,
  CAST(l_linenumber % 3 + 1 AS varchar) report, CAST(l_linenumber AS varchar) AS line,
  t.stmt, t.tag, t.tag || ' "row" ' || CAST(l_linenumber AS varchar) plabel,
  CAST(l_linenumber % 2 AS varchar) negating
 FROM lineitem JOIN tagdim t ON t.tid = l_partkey % 18""",
    "sym": """
 SELECT CASE WHEN c_custkey % 101 = 7 THEN repeat('x', 20)
   ELSE ' tk' || CAST(c_custkey AS varchar) || ' ' END symbol,
  CAST(c_custkey AS varchar) cik, 1 AS ord
 FROM customer WHERE c_custkey % 10 <> 0
 UNION ALL
 SELECT 'zz' || CAST(c_custkey AS varchar), CAST(c_custkey AS varchar), 2
 FROM customer WHERE c_custkey % 15 = 0""",
}


def parse(text: str) -> str:
    """Date of an 8-digit text."""
    return f"CAST(try_strptime({text}, '%Y%m%d') AS date)"


def periods(code: str, otherwise: str = "NULL") -> str:
    """Normalized fiscal period."""
    cases = " ".join(
        f"WHEN upper(trim({code})) IN {text_list(spellings)} THEN '{period}'"
        for period, spellings in FISCAL_PERIOD_SPELLINGS.items()
    )
    return f"CASE {cases} ELSE {otherwise} END"


def units(code: str) -> str:
    """Normalized unit."""
    cases = " ".join(
        f"WHEN upper(trim({code})) IN {text_list(spellings)} THEN '{unit}'"
        for unit, spellings in UNIT_SPELLINGS.items()
    )
    return f"CASE {cases} ELSE 'USD' END"


def guarded_date(text: str) -> str:
    """Date within the guard bounds."""
    return (f"CASE WHEN {parse(text)} BETWEEN DATE '1900-01-01' AND DATE '2100-01-01' "
            f"THEN {parse(text)} END")


def ends(start: str, code: str) -> str:
    """Last day of a document period."""
    cases = " ".join(
        f"WHEN {code} IN {text_list(codes)} THEN CAST({start} + INTERVAL {m} MONTH "
        f"- INTERVAL 1 DAY AS date)"
        for m, codes in PERIOD_MONTHS.items()
    )
    return f"CASE {cases} END"


def _staging(statement: str) -> str:
    return f"""
 SELECT * FROM (SELECT DISTINCT s.cik company_symbol, s.period filing_date, s.fy fiscal_year,
  {periods('s.fp')} fiscal_period, t.tlabel metric_name, n.tag metric_code,
  t.datatype metric_info, {units('n.uom')} measurement_unit,
  TRY_CAST(n.value AS decimal(38,4)) metric_value,
  '{SOURCE_LABELS[statement]}' source_file
  FROM num n JOIN sub s ON n.adsh = s.adsh JOIN tag t ON n.tag = t.tag
  WHERE n.tag IN {text_list(STATEMENT_TAGS[statement])} AND n.value IS NOT NULL) c
 WHERE company_symbol IS NOT NULL AND metric_value IS NOT NULL"""


def _fact_branch(name: str) -> str:
    return f"""SELECT company_symbol, fiscal_year, fiscal_period,
  {guarded_date('filing_date')} filing_date, metric_name, metric_value, metric_code,
  measurement_unit, source_file FROM {name}"""


_METRICS = ", ".join(
    f"max(CASE WHEN metric_code = '{tag}' THEN metric_value END) AS {name}"
    for name, tag in METRIC_COLUMNS.items()
)
_RATIOS = ", ".join(
    f"CASE WHEN {den} > 0 THEN CAST({num} AS double) / CAST({den} AS double) END AS {name}"
    for name, (num, den) in RATIO_COLUMNS.items()
)


def _statement_table(name: str) -> str:
    return f"""SELECT company_symbol symbol, metric_name AS label, metric_code concept,
  metric_info info, measurement_unit unit, CAST(metric_value AS double) AS value,
  source_file file_name, filing_date, fiscal_year, fiscal_period FROM {name}"""


def _side(name: str) -> str:
    return f"""SELECT company_symbol, fiscal_year, fiscal_period, filing_date, metric_code,
  CAST(max(metric_value) AS double) v FROM {name} GROUP BY ALL"""


_MODELS = {
    "stg_balance_sheet": _staging("balance_sheet"),
    "stg_income_statement": _staging("income_statement"),
    "stg_cash_flow": _staging("cash_flow"),
    "fct": "SELECT c.* FROM (" + " UNION ALL ".join(
        _fact_branch(n) for n in ("stg_balance_sheet", "stg_income_statement", "stg_cash_flow")
    ) + """) c JOIN (SELECT DISTINCT cik FROM sub WHERE cik IS NOT NULL) v
 ON c.company_symbol = v.cik
 WHERE metric_value IS NOT NULL AND filing_date IS NOT NULL AND fiscal_year IS NOT NULL
  AND fiscal_period IN ('Q1', 'Q2', 'Q3', 'Q4', 'FY')""",
    "pivoted": f"""SELECT company_symbol, fiscal_year, fiscal_period, filing_date, {_METRICS}
 FROM fct GROUP BY company_symbol, fiscal_year, fiscal_period, filing_date""",
    "metrics": f"SELECT *, {_RATIOS} FROM pivoted",
    "balance_sheet": _statement_table("stg_balance_sheet"),
    "income_statement": _statement_table("stg_income_statement"),
    "cash_flow": _statement_table("stg_cash_flow"),
    "fact_financials": f"""SELECT b.company_symbol, b.fiscal_year, b.fiscal_period,
  b.filing_date, b.metric_code balance_metric, i.metric_code income_metric,
  c.metric_code cash_flow_metric, b.v balance_value, i.v income_value, c.v cash_flow_value
 FROM ({_side('stg_balance_sheet')}) b
 JOIN ({_side('stg_income_statement')}) i USING (company_symbol, fiscal_year, fiscal_period, filing_date)
 JOIN ({_side('stg_cash_flow')}) c USING (company_symbol, fiscal_year, fiscal_period, filing_date)""",
    "first_symbol": """SELECT cik, symbol FROM (SELECT *, row_number() OVER (
  PARTITION BY cik ORDER BY ord, symbol) rn FROM sym) WHERE rn = 1""",
    "first_doc": """SELECT tag, doc FROM (SELECT *, row_number() OVER (
  PARTITION BY tag ORDER BY version NULLS FIRST, doc NULLS FIRST) rn FROM tag) WHERE rn = 1""",
    "first_pre": """SELECT adsh, tag, plabel, stmt FROM (SELECT *, row_number() OVER (
  PARTITION BY adsh, tag ORDER BY CAST(report AS int), CAST(line AS int), plabel, stmt) rn
  FROM pre) WHERE rn = 1""",
    "status": f"""SELECT adsh, startDate, {ends('startDate', 'quarter')} endDate, year, quarter,
  symbol, name, country, city, CASE WHEN startDate IS NULL THEN 'bad period'
   WHEN year IS NULL THEN 'bad year'
   WHEN {ends('startDate', 'quarter')} IS NULL THEN 'bad quarter'
   WHEN symbol IS NULL THEN 'no symbol'
   WHEN length(symbol) NOT BETWEEN 1 AND 19 THEN 'bad symbol' ELSE 'ok' END AS status
 FROM (SELECT s.adsh, {parse('s.period')} startDate,
   CASE WHEN s.fy IS NULL THEN 0 ELSE TRY_CAST(s.fy AS int) END AS year,
   upper(trim(s.fp)) AS quarter, upper(trim(y.symbol)) symbol, s.name,
   s.countryma country, s.cityma city
  FROM sub s LEFT JOIN first_symbol y ON s.cik = y.cik)""",
    "meta": """SELECT startDate, endDate, year, quarter, symbol, name, country, city
 FROM status WHERE status = 'ok'""",
    "doc_fact": """SELECT h.adsh, h.symbol, lower(p.stmt) data_type, d.doc AS label, n.tag concept,
  replace(p.plabel, '"', '''') info, n.uom unit,
  CAST(trunc(TRY_CAST(n.value AS decimal(28,4))) AS bigint) AS value
 FROM status h JOIN num n ON n.adsh = h.adsh JOIN first_doc d ON d.tag = n.tag
 JOIN first_pre p ON p.adsh = h.adsh AND p.tag = n.tag
 WHERE h.status = 'ok' AND p.stmt IN ('BS', 'CF', 'IC', 'IS')
  AND TRY_CAST(n.value AS decimal(28,4)) IS NOT NULL""",
    "fdata": """SELECT symbol, data_type, concept, info, unit, CAST(value AS double) AS value
 FROM doc_fact WHERE data_type IN ('bs', 'cf')""",
}

TABLES = {**_TABLES, **_MODELS}


def with_tables(body: str) -> str:
    """Prefix a query with the tables and models it names, directly or through others."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(re.findall(r"[a-z_]+", texts.pop()))
        for name in words & set(TABLES) - needed:
            needed.add(name)
            texts.append(TABLES[name])
    parts = [f"{name} AS ({text.strip()})" for name, text in TABLES.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
