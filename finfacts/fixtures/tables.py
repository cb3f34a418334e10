"""Map the star-schema test tables to the raw filing tables.

The mapping is plain SQL over whole tables and puts in dirty values on purpose.
``oracle.py`` holds its counterpart for the check engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.schema import RAW_COLUMNS

# Fixed values: (tag, statement code) of the tag dictionary, in id order.
TAG_DIMENSION = (
    ("Assets", "BS"),
    ("Liabilities", "BS"),
    ("StockholdersEquity", "BS"),
    ("CashAndCashEquivalents", "BS"),
    ("AccountsReceivable", "BS"),
    ("Inventory", "BS"),
    ("OperatingIncomeLoss", "IS"),
    ("NetIncomeLoss", "IS"),
    ("EarningsPerShareBasic", "IS"),
    ("EarningsPerShareDiluted", "IS"),
    ("Revenues", "IS"),
    ("CostOfRevenue", "IC"),
    ("NetCashProvidedByUsedInFinancingActivities", "CF"),
    ("NetCashProvidedByUsedInOperatingActivities", "CF"),
    ("NetCashProvidedByUsedInInvestingActivities", "CF"),
    ("CustomTagA", "EQ"),
    ("CustomTagB", "CI"),
    ("UnlistedTag", "UN"),
)

ADSH = "lpad(cast({0} AS string), 18, '0')"

SUB = f"""
SELECT {ADSH.format('o_orderkey')} adsh, cast(o_custkey AS string) cik, c_name name,
  n_name countryma, c_mktsegment cityma,
  CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '8-K' END form,
  CASE WHEN o_orderkey % 97 = 0 THEN 'bad'
    ELSE date_format(o_orderdate, 'yyyyMMdd') END period,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL
    ELSE cast(year(o_orderdate) AS string) END fy,
  CASE o_orderkey % 9 WHEN 0 THEN 'Q1' WHEN 1 THEN ' qtr2 ' WHEN 2 THEN '3RD'
    WHEN 3 THEN 'fourth' WHEN 4 THEN 'FY' WHEN 5 THEN 'H1' WHEN 7 THEN 'annual'
    WHEN 8 THEN 'q4' END fp,
  date_format(o_orderdate + INTERVAL 30 DAYS, 'yyyyMMdd') filed
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey
"""

NUM = f"""
SELECT {ADSH.format('l_orderkey')} adsh, t.tag, 'us-gaap/2022' version,
  date_format(l_shipdate, 'yyyyMMdd') ddate, cast(l_linenumber % 5 AS string) qtrs,
  CASE l_linenumber % 6 WHEN 0 THEN 'USD' WHEN 1 THEN ' usd ' WHEN 2 THEN '$'
    WHEN 3 THEN 'Shares' WHEN 4 THEN 'pct' ELSE 'EUR' END uom,
  CASE WHEN l_suppkey % 10 = 3 AND l_linenumber = 1 THEN NULL
    WHEN l_suppkey % 10 = 4 AND l_linenumber = 2 THEN 'n/a'
    ELSE cast(cast(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice
      ELSE l_extendedprice END AS decimal(28,4)) AS string) END value
FROM {{lineitem}} JOIN {{tagdim}} t ON t.tid = l_partkey % 18
"""

# Labels and texts of the listed tags come from the parts that share their number; every
# part is a company's own tag besides, so the dictionary grows with the given table.
TAG = """
SELECT tag, concat('us-gaap/', v) version, IF(tag LIKE 'Custom%', '1', '0') custom,
  '0' abstract, 'monetary' datatype, IF(stmt = 'BS', 'I', 'D') iord,
  concat(tag, ' ', IF(v = '2022', lower(kind), 'v2')) tlabel, concat('Doc of ', name, ' ', v) doc
FROM (SELECT *, explode(IF(tid % 5 = 0, array('2022', '2023'), array('2022'))) v
  FROM {tagdim} WHERE tag <> 'UnlistedTag')
JOIN (SELECT p_partkey % 18 part, min(p_type) kind, min(p_name) name FROM {part} GROUP BY 1) ON part = tid
UNION ALL
SELECT concat('Own', p_partkey), p_brand, '1', '0', 'monetary', 'D', p_type, p_name FROM {part}
"""

PRE = f"""
SELECT DISTINCT {ADSH.format('l_orderkey')} adsh,
  cast(l_linenumber % 3 + 1 AS string) report, cast(l_linenumber AS string) line, t.stmt,
  '0' inpth, 'H' rfile, t.tag, 'us-gaap/2022' version,
  concat(t.tag, ' "row" ', cast(l_linenumber AS string)) plabel,
  cast(l_linenumber % 2 AS string) negating
FROM {{lineitem}} JOIN {{tagdim}} t ON t.tid = l_partkey % 18
"""

SYM = """
SELECT CASE WHEN c_custkey % 101 = 7 THEN repeat('x', 20)
  ELSE concat(' tk', cast(c_custkey AS string), ' ') END symbol,
  cast(c_custkey AS string) cik, 1 ord
FROM {customer} WHERE c_custkey % 10 <> 0
UNION ALL
SELECT concat('zz', cast(c_custkey AS string)), cast(c_custkey AS string), 2
FROM {customer} WHERE c_custkey % 15 = 0
"""


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _complete(df: DataFrame, table: str) -> DataFrame:
    """All raw columns in file order; columns the mapping does not fill are NULL."""
    missing = {
        c: F.lit(None).cast("string") for c in RAW_COLUMNS[table] if c not in df.columns
    }
    return df.withColumns(missing).select(*RAW_COLUMNS[table]) if missing else df.select(
        *RAW_COLUMNS[table]
    )


def filing_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy ``sub, num, tag, pre, sym`` over the test tables in ``sf_dir``."""
    source = {n: given_table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "lineitem", "part")}
    entries = ", ".join(
        f"({i}, '{tag}', '{stmt}')" for i, (tag, stmt) in enumerate(TAG_DIMENSION)
    )
    tagdim = spark.sql(f"SELECT * FROM VALUES {entries} AS t(tid, tag, stmt)")
    return {
        "sub": _complete(spark.sql(
            SUB, orders=source["orders"], customer=source["customer"], nation=source["nation"]
        ), "sub"),
        "num": _complete(spark.sql(NUM, lineitem=source["lineitem"], tagdim=tagdim), "num"),
        "tag": _complete(spark.sql(TAG, tagdim=tagdim, part=source["part"]), "tag"),
        "pre": _complete(spark.sql(PRE, lineitem=source["lineitem"], tagdim=tagdim), "pre"),
        "sym": spark.sql(SYM, customer=source["customer"]),
    }
