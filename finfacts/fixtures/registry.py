"""Registered queries over the test tables, each beside its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finfacts import functions as B
from finfacts.fixtures import oracle as O
from finfacts.fixtures.tables import filing_tables, given_table
from finfacts.operators import aggregates as D, joins as C, links, nested, quality as Q
from finfacts.operators.variants import flatten_variants, variant_metadata
from finfacts.plans import (
    buckets, catalog as N, checks as K, distinct, filings as P, periods, rewrites, statements as S,
)
from finfacts.schema import (
    DOC_HEADER, DOC_SCHEMA, DOCUMENT_PARTS, FISCAL_PERIODS, RATIO_COLUMNS, RAW_COLUMNS,
)
from finfacts.plans.forms import load_form
from finfacts.sources.documents import read_documents, write_documents
from finfacts.sources.layout import store_by_keys
from finfacts.sources.loads import (
    landed_documents, load_documents, load_raw, load_report, loaded_rows, refused_rows,
)
from finfacts.sources.manifest import missing_periods, staged_manifest
from finfacts.sources.raw import read_raw, read_tickers, typed
from finfacts.sources.sinks import replace_view, save_model, scratch_folder, shuffles_freed
from finfacts.streaming.compaction import compact_landed, landed_table
from finfacts.streaming.landing import ingest_documents
from finfacts.streaming.statements import ingest_statements, ingested_statements

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
BUILDS: dict[str, Callable[..., DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Callable[..., DataFrame], sql: str | None = None) -> None:
    """Register ``build(tables)`` over the filing tables of a data directory."""
    BUILDS[name] = build
    QUERIES[name] = lambda spark, sf_dir: build(filing_tables(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = O.with_tables(sql)


def add_direct(name: str, build: Query, sql: str | None = None) -> None:
    """Register a query that takes the session and the data directory."""
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = O.with_tables(sql)


def rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    """Round double columns for comparison across engines."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- A: sources and typing -------------------------------------------------

add("a3_typed_sub",
    lambda t: typed(t["sub"], "sub").select("adsh", "cik", "name", "form", "period", "fy", "fp", "filed"),
    "SELECT adsh, cik, name, form, period, fy, fp, filed FROM sub")
add("a3_typed_num",
    lambda t: typed(t["num"], "num").select(
        "adsh", "tag", "version", "ddate", "qtrs", "uom", "value"),
    f"""SELECT adsh, tag, version, {O.parse('ddate')} ddate, TRY_CAST(qtrs AS int) qtrs, uom,
    TRY_CAST(value AS decimal(28,4)) AS value FROM num""")
add("a3_typed_tag",
    lambda t: typed(t["tag"], "tag").select(
        "tag", "version", "custom", "abstract", "datatype", "iord", "tlabel", "doc"),
    """SELECT tag, version, TRY_CAST(custom AS boolean) AS custom,
    TRY_CAST(abstract AS boolean) AS abstract, datatype, iord, tlabel, doc FROM tag""")
add("a3_typed_pre",
    lambda t: typed(t["pre"], "pre").select("adsh", "report", "line", "stmt", "tag", "plabel", "negating"),
    """SELECT adsh, CAST(report AS int) report, CAST(line AS int) AS line, stmt, tag, plabel,
    CAST(negating AS int) negating FROM pre""")


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = B.parse_period(F.col("period"))
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    loaded = filing_tables(spark, sf_dir)["sub"].select(
        B.period_key(F.year(day), quarter, first_year=1990).alias("period_folder")
    ).distinct()
    return missing_periods(spark, loaded, last=2005, first=1993)


add_direct("a6_missing_periods", _missing, f"""
SELECT CAST(y AS int) AS year, 'Q' || q AS quarter, y || 'q' || q AS period_folder
FROM range(1993, 2006) a(y), range(1, 5) b(q)
WHERE y || 'q' || q NOT IN (SELECT DISTINCT year(d) || 'q' || quarter(d)
  FROM (SELECT {O.parse('period')} d FROM sub) WHERE d IS NOT NULL)""")
add_direct("a11_extract_links",
    lambda spark, d: links.extract_links(given_table(spark, d, "pages"), "e", inside_table=False),
    """WITH pieces AS (
      SELECT page_id, unnest(string_split(replace(html, '<A ', '<a '), '<a ')[2:]) p FROM pages
    ), parts AS (
      SELECT page_id, ' ' || string_split(p, '>')[1] attrs, string_split(substr(p, strpos(p, '>') + 1), '<')[1] link_text
      FROM pieces WHERE contains(p, '>')
    ), named AS (
      SELECT page_id, link_text, substr(attrs, strpos(lower(attrs), ' href=') + 6) v
      FROM parts WHERE contains(lower(attrs), ' href=')
    ), valued AS (
      SELECT page_id, link_text, CASE WHEN v[1] IN (chr(34), chr(39)) THEN string_split(v, v[1])[2]
        ELSE string_split(v, ' ')[1] END href FROM named
    ) SELECT page_id, href, link_text, string_split(href, '/')[-1] file_name
    FROM valued WHERE contains(link_text, 'e')""")



def _write_raw(spark: SparkSession, sf_dir: str, names=("sub", "num", "tag", "pre")) -> str:
    """The raw tables as tab-separated files in the shared folder, as one quarter."""
    root = scratch_folder(spark)
    tables = filing_tables(spark, sf_dir)
    for name in names:
        with shuffles_freed(spark):
            (
                tables[name].write.option("sep", "\t").option("header", True).option("escape", '"')
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                .option("compression", "gzip").csv(f"{root}/2022q4/{name}.txt")
            )
    return root


def _write_documents(spark: SparkSession, sf_dir: str) -> str:
    """The filing documents as JSON lines in the shared folder, by quarter of their start."""
    root = scratch_folder(spark)
    quarter = F.concat(F.lit("Q"), F.quarter("startDate").cast("string"))
    docs = P.filing_documents(filing_tables(spark, sf_dir)).withColumn(
        "period_folder", B.period_key(F.year("startDate"), quarter, first_year=1990))
    write_documents(docs, root)
    return root


def _saved_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark)
    save_model(S.fct_financial_statements(filing_tables(spark, sf_dir)), root,
               partition_by=["fiscal_period"])
    return spark.read.parquet(root)


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = scratch_folder(spark)
    ingest_documents(spark, _write_documents(spark, sf_dir), landed, f"{landed}/checkpoint")
    return spark.read.parquet(f"{landed}/financial_data").drop("ingest_batch")


def _ddate_quarter() -> Column:
    day = B.parse_period(F.col("ddate"))
    return B.period_key(F.year(day), F.concat(F.lit("Q"), F.quarter(day).cast("string")), first_year=1990)


_DDATE_QUARTER = f"year({O.parse('ddate')}) || 'q' || quarter({O.parse('ddate')})"


def _write_values(spark: SparkSession, sf_dir: str, member: Column | None = None) -> str:
    """The reported values as tab-separated files by quarter of their date, one file for each member."""
    root = scratch_folder(spark)
    num = filing_tables(spark, sf_dir)["num"].select(
        "*", _ddate_quarter().alias("period_folder"), (F.lit("num.txt") if member is None else member).alias("member"))
    with shuffles_freed(spark):
        (
            num.repartition("period_folder", "member").write.partitionBy("period_folder", "member")
            .option("sep", "\t").option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("compression", "gzip").csv(root)
        )
    return root


def _manifest_of_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of folders whose names and numbers of files come from the data."""
    return staged_manifest(spark, _write_values(spark, sf_dir, F.col("tag"))).select(
        "period_folder", "files", (F.col("bytes") > 0).alias("filled"),
        F.col("archive").isNull().alias("no_archive"))


add_direct("a1_read_raw",
    lambda spark, d: read_raw(spark, _write_raw(spark, d, ["num"]), "num", ["2022q4"]).select(
        "adsh", "tag", "version", "ddate", "qtrs", "uom", "value", "period_folder"),
    """SELECT adsh, tag, version, ddate, qtrs, trim(uom) uom, value, '2022q4' period_folder FROM num""")
add_direct("a2_skip_invalid_rows",
    lambda spark, d: typed(read_raw(spark, _write_raw(spark, d, ["num"]), "num", on_error="skip"),
                           "num", on_error="skip").select("adsh", "tag", "value"),
    """SELECT adsh, tag, TRY_CAST(value AS decimal(28,4)) AS value FROM num
    WHERE value IS NULL OR TRY_CAST(value AS decimal(28,4)) IS NOT NULL""")
add_direct("a5_staged_manifest",
    _manifest_of_periods,
    f"""SELECT {_DDATE_QUARTER} period_folder, count(DISTINCT tag) files, true filled, true no_archive
    FROM num GROUP BY 1""")


def _loaded_in_steps(spark: SparkSession, sf_dir: str) -> str:
    """Values loaded in two steps, the second over all files, and then once more and by force."""
    root, dst = _write_values(spark, sf_dir), scratch_folder(spark)
    load = lambda **options: load_raw(spark, root, "num", dst, unpacked=True, **options)
    load(periods=["*q[12]"])
    load()
    if load().files or not load(periods=["*q1"], force=True).files:
        raise AssertionError("a file was taken twice, or not by force")
    return dst


_FITS = "(value IS NULL OR TRY_CAST(value AS decimal(28,4)) IS NOT NULL)"
add_direct("a1_load_history",
    lambda spark, d: loaded_rows(spark, _loaded_in_steps(spark, d)).select(
        "adsh", "tag", "version", "ddate", "qtrs", "uom", "value", "period_folder"),
    f"""SELECT adsh, tag, version, ddate, qtrs, trim(uom) uom, value, {_DDATE_QUARTER} period_folder
    FROM num WHERE {_FITS}""")
add_direct("a2_load_report",
    lambda spark, d: load_report(spark, _loaded_in_steps(spark, d), ["period_folder"]),
    f"""SELECT *, CASE WHEN rows_refused = 0 THEN 'LOADED' WHEN rows_kept = 0 THEN 'LOAD_FAILED'
      ELSE 'PARTIALLY_LOADED' END status
    FROM (SELECT {_DDATE_QUARTER} period_folder, count(*) rows_read, count(*) FILTER ({_FITS}) rows_kept,
      count(*) FILTER (NOT {_FITS}) rows_refused,
      max('value is no decimal(28,4)') FILTER (NOT {_FITS}) first_reason FROM num GROUP BY 1)""")
add_direct("a2_refused_rows",
    lambda spark, d: refused_rows(spark, _loaded_in_steps(spark, d)).select(
        "adsh", "tag", "value", "reason", "period_folder"),
    f"""SELECT adsh, tag, value, 'value is no decimal(28,4)' reason, {_DDATE_QUARTER} period_folder
    FROM num WHERE NOT {_FITS}""")


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    dst = scratch_folder(spark)
    load_documents(spark, _write_documents(spark, sf_dir), dst)
    return landed_documents(spark, dst)


def _replaced_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table under a view that another table held before."""
    t, root = filing_tables(spark, sf_dir), scratch_folder(spark)
    name = f"facts_{root[-32:]}"
    replace_view(S.stg_balance_sheet(t), name, root)
    replace_view(S.fct_financial_statements(t), name, root)
    return spark.table(name)


add_direct("a7_read_documents",
    lambda spark, d: P.document_tables(read_documents(spark, _write_documents(spark, d)))[1],
    "SELECT * FROM fdata")
add_direct("a8_write_documents",
    lambda spark, d: nested.document_metadata(read_documents(spark, _write_documents(spark, d))),
    """SELECT year(startDate) || 'q' || quarter(startDate) period_folder, * FROM meta""")
def _tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    symbols = filing_tables(spark, sf_dir)["sym"].select("symbol", "cik")
    (
        symbols.write.option("sep", "\t").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return C.lookup_symbol(read_tickers(spark, path))


add_direct("a9_read_tickers", _tickers, "SELECT cik, symbol FROM first_symbol")
add_direct("a10_save_model", _saved_facts, "SELECT * FROM fct")
add_direct("a10_replace_view", _replaced_facts, "SELECT * FROM fct")
add_direct("i1_ingest_documents", _ingested,
    """SELECT year(h.startDate) || 'q' || quarter(h.startDate) period_folder, d.symbol, data_type, concept,
    info, unit, CAST(value AS double) AS value FROM doc_fact d JOIN status h ON h.adsh = d.adsh
    WHERE data_type IN ('bs', 'cf')""")


def _streamed_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows of values that arrive as a stream of files, a few in a batch."""
    dst = scratch_folder(spark)
    tables = filing_tables(spark, sf_dir)
    ingest_statements(spark, _write_values(spark, sf_dir), {k: tables[k] for k in ("sub", "tag")}, f"{dst}/rows",
                      f"{dst}/checkpoint", unpacked=True, files_per_batch=10)
    return ingested_statements(spark, f"{dst}/rows")


add_direct("i1_ingest_statements", _streamed_statements,
    """SELECT * FROM stg_balance_sheet UNION ALL SELECT * FROM stg_income_statement
    UNION ALL SELECT * FROM stg_cash_flow""")


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that land a few files at a time, with their batches merged."""
    landed = scratch_folder(spark)
    ingest_documents(spark, _write_documents(spark, sf_dir), landed, f"{landed}/checkpoint", files_per_batch=6)
    compact_landed(spark, landed, "financial_data")
    return landed_table(spark, landed, "financial_data").drop("ingest_batch")


add_direct("i1_compact_landed", _compacted)
ORACLES["i1_compact_landed"] = ORACLES["i1_ingest_documents"]
add_direct("m11_raw_form",
    lambda spark, d: D.table_counts({
        k: v for k, v in load_form(spark, "RAW", _write_raw(spark, d)).items() if k in RAW_COLUMNS}),
    " UNION ALL ".join(f"SELECT '{k}' AS \"table\", count(*) row_count FROM {k}" for k in RAW_COLUMNS))
add_direct("m11_json_form",
    lambda spark, d: load_form(spark, "JSON", _write_documents(spark, d))["financial_data"].drop("id"),
    "SELECT * FROM fdata")
add_direct("m11_storage_forms",
    lambda spark, d: rounded(
        load_form(spark, "NORMALIZED", _write_raw(spark, d), store=scratch_folder(spark))["company_metrics"], RATIO_COLUMNS),
    "SELECT * REPLACE (" + ", ".join(f"round({r}, 6) AS {r}" for r in RATIO_COLUMNS) + ") FROM metrics")

# ---- B: scalars and predicates ----------------------------------------------

add("b1_fiscal_period",
    lambda t: t["sub"].select("adsh", "fp", B.norm_fiscal_period(F.col("fp")).alias("fiscal_period")),
    f"SELECT adsh, fp, {O.periods('fp')} fiscal_period FROM sub")
add("b2_unit",
    lambda t: t["num"].groupBy("uom", B.norm_unit(F.col("uom")).alias("unit")).agg(
        F.count("*").alias("row_count")),
    f"SELECT uom, {O.units('uom')} unit, count(*) row_count FROM num GROUP BY ALL")
add("b3_safe_decimal",
    lambda t: t["num"].select("adsh", "tag", "value", B.safe_decimal(F.col("value")).alias("metric_value")),
    "SELECT adsh, tag, value, TRY_CAST(value AS decimal(38,4)) metric_value FROM num")
add("b4_safe_date",
    lambda t: t["sub"].select("adsh", "period", B.safe_date(F.col("period")).alias("filing_date")),
    f"SELECT adsh, period, {O.guarded_date('period')} filing_date FROM sub")
add("b5_filter_statement",
    lambda t: S.filter_statement(t["num"], ["cash_flow"]).select("adsh", "tag", "uom", "value"),
    f"""SELECT adsh, tag, uom, value FROM num WHERE value IS NOT NULL
    AND tag IN {O.text_list(S.STATEMENT_TAGS['cash_flow'])}""")
add("b6_value_guards",
    lambda t: S.staging(t).groupBy("metric_code").agg(
        F.count("*").alias("row_count"), F.count("company_symbol").alias("companies"),
        F.count("metric_value").alias("metric_values")),
    """SELECT metric_code, count(*) row_count, count(*) companies, count(*) metric_values FROM (
    SELECT * FROM stg_balance_sheet UNION ALL SELECT * FROM stg_income_statement
    UNION ALL SELECT * FROM stg_cash_flow) GROUP BY ALL""")
add("b7_source_label",
    lambda t: t["num"].select("tag", B.statement_source(F.col("tag")).alias("source_file")).groupBy(
        "tag", "source_file").agg(F.count("*").alias("row_count")),
    "SELECT tag, CASE " + " ".join(
        f"WHEN tag IN {O.text_list(tags)} THEN '{S.SOURCE_LABELS[s]}'"
        for s, tags in S.STATEMENT_TAGS.items()
    ) + " END source_file, count(*) row_count FROM num GROUP BY ALL")
add("b8_parse_period",
    lambda t: t["sub"].select("adsh", B.parse_period(F.col("period")).alias("start_date"),
                              B.parse_period(F.col("period")).isNull().alias("rejected")),
    f"SELECT adsh, {O.parse('period')} start_date, {O.parse('period')} IS NULL rejected FROM sub")
add("b9_period_end",
    lambda t: t["sub"].select("adsh", B.period_end(
        B.parse_period(F.col("period")), B.doc_quarter(F.col("fp"))).alias("end_date")),
    f"SELECT adsh, {O.ends(O.parse('period'), 'upper(trim(fp))')} end_date FROM sub")
add("b10_doc_year_quarter",
    lambda t: t["sub"].select("adsh", B.doc_year(F.col("fy")).alias("year"),
                              B.doc_quarter(F.col("fp")).alias("quarter")),
    "SELECT adsh, coalesce(TRY_CAST(fy AS int), 0) AS year, upper(trim(fp)) AS quarter FROM sub")
add("b11_norm_symbol",
    lambda t: t["sym"].select("cik", "ord", B.norm_symbol(F.col("symbol")).alias("symbol")),
    """SELECT cik, ord, CASE WHEN length(trim(symbol)) BETWEEN 1 AND 19
    THEN upper(trim(symbol)) END symbol FROM sym""")
add("b12_doc_value",
    lambda t: t["num"].select("adsh", "tag", B.doc_value(F.col("value")).alias("value")),
    """SELECT adsh, tag, CAST(trunc(TRY_CAST(value AS decimal(28,4))) AS bigint) AS value FROM num""")
add("b13_clean_label",
    lambda t: t["pre"].select("adsh", "tag", "line", B.clean_text(F.col("plabel"), label=True).alias("info")),
    "SELECT adsh, tag, line, replace(plabel, '\"', '''') info FROM pre")
add_direct("b13_clean_text",
    lambda spark, d: given_table(spark, d, "documents").select(
        "doc_id", B.clean_text(F.col("text")).alias("cleaned")),
    "SELECT doc_id, replace(replace(text, chr(13), ''), chr(10), ' ') cleaned FROM documents")
add("b14_route_stmt",
    lambda t: t["pre"].groupBy("stmt", B.route_stmt(F.col("stmt")).alias("part")).agg(
        F.count("*").alias("row_count")),
    """SELECT stmt, CASE WHEN stmt IN ('BS', 'CF', 'IC') THEN lower(stmt) END AS part,
    count(*) row_count FROM pre GROUP BY ALL""")
add("b15_safe_ratio",
    lambda t: t["num"].select("adsh", "tag", "qtrs", F.round(B.safe_ratio(
        F.col("qtrs").try_cast("int"), B.safe_decimal(F.col("value"))), 9).alias("ratio")),
    """SELECT adsh, tag, qtrs, round(CASE WHEN TRY_CAST(value AS decimal(38,4)) > 0
    THEN CAST(qtrs AS double) / CAST(TRY_CAST(value AS decimal(38,4)) AS double) END, 9) ratio FROM num""")


def _variant_fields(t) -> DataFrame:
    docs = P.filing_documents(t).select(
        F.parse_json(F.to_json(F.struct(*DOC_HEADER, "data"))).alias("doc"))
    return docs.select(
        B.doc_field(F.col("doc"), "symbol", "string").alias("symbol"),
        B.doc_field(F.col("doc"), "startDate", "date").alias("start_date"),
        B.doc_field(F.col("doc"), "year", "int").alias("year"),
        B.doc_field(F.col("doc"), "quarter", "string").alias("quarter"),
        B.doc_field(F.col("doc"), "data.bs[0].concept", "string").alias("first_concept"),
    )


add("b16_doc_field", _variant_fields, """
SELECT s.symbol, s.startDate start_date, s.year, s.quarter, first_concept FROM status s
LEFT JOIN (SELECT adsh, arg_min(concept, (label, concept, info, unit, value)) first_concept
  FROM doc_fact WHERE data_type = 'bs' GROUP BY adsh) f ON f.adsh = s.adsh
WHERE s.status = 'ok'""")


def _period_keys(t) -> DataFrame:
    day = B.parse_period(F.col("period"))
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    return t["sub"].select("adsh", B.period_key(F.year(day), quarter).alias("period_folder"))


add("b17_load_time",
    lambda t: S.fct_financial_statements(t, load_time=True).groupBy("source_file").agg(
        F.count("dbt_loaded_at").alias("loaded_rows")),
    "SELECT source_file, count(*) loaded_rows FROM fct GROUP BY ALL")
add("b18_period_key", _period_keys, f"""
SELECT adsh, CASE WHEN year(d) BETWEEN 2000 AND 2100 THEN year(d) || 'q' || quarter(d) END period_folder
FROM (SELECT adsh, {O.parse('period')} d FROM sub)""")
add("b19_safe_year",
    lambda t: t["sub"].select("adsh", B.safe_year(F.col("fy")).alias("fiscal_year")),
    "SELECT adsh, TRY_CAST(fy AS int) fiscal_year FROM sub")
add("b20_fiscal_period_open",
    lambda t: t["sub"].select("adsh", B.norm_fiscal_period(F.col("fp"), keep_unknown=True).alias("fiscal_period")),
    f"SELECT adsh, {O.periods('fp', 'fp')} fiscal_period FROM sub")

# ---- C: joins --------------------------------------------------------------

add("c1_join_filing",
    lambda t: C.join_filing(t["num"].select("adsh", "tag", "value"),
                            t["sub"].select("adsh", "cik", "period", "fy", "fp")),
    "SELECT n.adsh, tag, value, cik, period, fy, fp FROM num n JOIN sub s ON n.adsh = s.adsh")
add("c2_join_tag",
    lambda t: C.join_tag(t["num"].select("adsh", "tag", "value"), t["tag"]).select(
        "adsh", "tag", "value", "tag_version", "tlabel", "datatype"),
    """SELECT n.adsh, n.tag, n.value, t.version tag_version, t.tlabel, t.datatype
    FROM num n JOIN tag t ON n.tag = t.tag""")
add("c3_valid_companies",
    lambda t: C.valid_companies(
        t["sym"].select(F.col("cik").alias("company_symbol"), "symbol"), t["sub"]),
    "SELECT cik company_symbol, symbol FROM sym WHERE cik IN (SELECT cik FROM sub)")
add("c4_lookup_tag_doc", lambda t: C.lookup_tag_doc(t["tag"]), "SELECT tag, doc FROM first_doc")
add("c5_lookup_presentation", lambda t: C.lookup_presentation(t["pre"]),
    "SELECT adsh, tag, plabel, stmt FROM first_pre")
add("c6_lookup_symbol", lambda t: C.lookup_symbol(t["sym"]), "SELECT cik, symbol FROM first_symbol")
add("c7_join_doc_tables",
    lambda t: C.join_doc_tables(P.financial_metadata(t), P.financial_data(t),
                                ["name", "country"], ["data_type", "concept", "unit"]),
    """SELECT m.symbol, name, country, data_type, concept, unit, count(*) row_count
    FROM meta m JOIN fdata f ON m.symbol = f.symbol GROUP BY ALL""")

_FANOUT = """SELECT b.symbol,
  CAST(sum(CASE WHEN b.concept = 'Assets' THEN CAST(b.value AS decimal(28,4)) ELSE 0 END) AS double) total_assets,
  CAST(sum(CASE WHEN b.concept = 'Liabilities' THEN CAST(b.value AS decimal(28,4)) ELSE 0 END) AS double) total_liabilities,
  CAST(sum(CASE WHEN c.concept = 'NetCashProvidedByUsedInOperatingActivities' THEN CAST(c.value AS decimal(28,4)) ELSE 0 END) AS double) operating_cash_flow,
  CAST(sum(CASE WHEN i.concept = 'Revenues' THEN CAST(i.value AS decimal(28,4)) ELSE 0 END) AS double) revenue
 FROM balance_sheet b LEFT JOIN cash_flow c ON b.symbol = c.symbol
 LEFT JOIN income_statement i ON b.symbol = i.symbol GROUP BY b.symbol"""
_HEALTH = ("total_assets", "total_liabilities", "operating_cash_flow", "revenue")
_ROUNDED = "SELECT symbol, " + ", ".join(f"round({c}, 2) {c}" for c in _HEALTH)
add("c8_health_fanout",
    lambda t: rounded(N.health_indicators(t, k=None), _HEALTH, 2),
    f"{_ROUNDED} FROM ({_FANOUT})")
add("c9_orphans",
    lambda t: C.orphans(
        t["sym"].select(B.norm_symbol(F.col("symbol")).alias("symbol"), "cik"),
        P.financial_metadata(t)),
    """SELECT symbol, cik FROM (SELECT cik, CASE WHEN length(trim(symbol)) BETWEEN 1 AND 19
      THEN upper(trim(symbol)) END symbol FROM sym) s
    WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.symbol = s.symbol)""")

# ---- D: aggregates -----------------------------------------------------------

_STATS = """CAST(sum(CAST(value AS decimal(28,4))) AS double) / count(value) avg_value,
 max(value) max_value, min(value) min_value"""
add("d1_count_by", lambda t: D.count_by(t["sub"], ["form", "fp"]),
    "SELECT form, fp, count(*) row_count FROM sub GROUP BY ALL")
add("d2_metric_stats",
    lambda t: D.metric_stats(S.balance_sheet(t), ["symbol", "concept"]),
    f"SELECT symbol, concept, {_STATS} FROM balance_sheet GROUP BY ALL")
add("d3_pivot_metrics",
    lambda t: D.pivot_metrics(S.fct_financial_statements(t), S.METRIC_KEYS),
    "SELECT * FROM pivoted")
add("d4_conditional_totals",
    lambda t: D.conditional_totals(
        S.fct_financial_statements(t), ["company_symbol"],
        {"assets": F.col("metric_code") == "Assets",
         "income_total": F.col("source_file") == "SEC_INCOME_STATEMENT"}, "metric_value"),
    """SELECT company_symbol, sum(CASE WHEN metric_code = 'Assets' THEN metric_value ELSE 0 END) assets,
    sum(CASE WHEN source_file = 'SEC_INCOME_STATEMENT' THEN metric_value ELSE 0 END) income_total
    FROM fct GROUP BY ALL""")
add("d5_having",
    lambda t: D.conditional_totals(
        S.fct_financial_statements(t), ["company_symbol"],
        {"total_assets": F.col("metric_code") == "Assets"}, "metric_value"
    ).filter(F.col("total_assets") > 0),
    """SELECT company_symbol, sum(CASE WHEN metric_code = 'Assets' THEN metric_value ELSE 0 END) total_assets
    FROM fct GROUP BY company_symbol HAVING total_assets > 0""")
add("d6_load_counts", lambda t: D.load_counts(P.financial_metadata(t), P.financial_data(t)),
    """SELECT 'Metadata Count' check_type, count(*) record_count, count(DISTINCT symbol) unique_symbols FROM meta
    UNION ALL SELECT 'Financial Data Count', count(*), count(DISTINCT symbol) FROM fdata""")


def _counts_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load counts after four loads that share companies; a filing comes with one of them."""
    t, store = filing_tables(spark, sf_dir), scratch_folder(spark)
    load = F.pmod(F.col("adsh").cast("bigint"), F.lit(4))
    for i in range(4):
        own = {**t, **{n: t[n].filter(load == i) for n in ("sub", "num", "pre")}}
        distinct.add_counts({"Metadata Count": P.financial_metadata(own),
                             "Financial Data Count": P.financial_data(own)}, store, f"2022q{i + 1}")
    return distinct.load_counts_of_periods(spark, store)


add_direct("d6_load_counts_of_periods", _counts_in_periods)
ORACLES["d6_load_counts_of_periods"] = ORACLES["d6_load_counts"]
add("d7_distinct_rows", lambda t: t["num"].select("adsh", "tag", "uom", "value").distinct(),
    "SELECT DISTINCT adsh, tag, uom, value FROM num")
add("d8_invalid_fiscal_periods", lambda t: D.invalid_fiscal_periods(t["sub"], "fp"),
    """SELECT fp, count(*) record_count FROM sub WHERE fp NOT IN ('Q1', 'Q2', 'Q3', 'Q4', 'FY')
    GROUP BY fp HAVING count(*) > 0""")
_DOC_ROWS = "SELECT adsh, symbol, data_type, label, concept, info, unit, value FROM doc_fact WHERE data_type <> 'is'"
add("d9_assemble_documents",
    lambda t: nested.flatten_documents(P.filing_documents(t), DOCUMENT_PARTS), _DOC_ROWS)
add("d10_table_counts",
    lambda t: D.table_counts({k: t[k] for k in RAW_COLUMNS}),
    " UNION ALL ".join(f"SELECT '{k}' AS \"table\", count(*) row_count FROM {k}" for k in RAW_COLUMNS))
add("d11_filing_status", lambda t: P.filing_status_counts(t["sub"], t["sym"]),
    "SELECT status, count(*) filings FROM status GROUP BY status")

# ---- F, G: order, limits, unions -----------------------------------------------

add("f1_latest_values",
    lambda t: D.top_k(t["num"].select("adsh", "tag", "ddate", "uom", "value"),
                      [F.col("ddate").desc(), "adsh", "tag", "uom", F.col("value").asc_nulls_last()], 10),
    """SELECT adsh, tag, ddate, uom, value FROM num
    ORDER BY ddate DESC, adsh, tag, uom, value NULLS LAST LIMIT 10""")
add("f2_top_filers",
    lambda t: D.top_k(D.count_by(t["num"], ["adsh"]), [F.col("row_count").desc(), "adsh"], 15),
    """SELECT adsh, count(*) row_count FROM num GROUP BY adsh ORDER BY row_count DESC, adsh LIMIT 15""")
add("f3_mixed_order",
    lambda t: D.top_k(t["sub"].select("adsh", "name", "fy", "filed"),
                      [F.col("fy").desc_nulls_last(), "name", F.col("filed").desc(), "adsh"], 20),
    """SELECT adsh, name, fy, filed FROM sub
    ORDER BY fy DESC NULLS LAST, name, filed DESC, adsh LIMIT 20""")
add("f4_full_order", lambda t: t["sub"].select("adsh", "cik", "filed").orderBy(F.col("filed").desc(), "adsh"),
    "SELECT adsh, cik, filed FROM sub ORDER BY filed DESC, adsh")
add("g1_union_statements",
    S.staging,
    """SELECT * FROM stg_balance_sheet UNION ALL SELECT * FROM stg_income_statement
    UNION ALL SELECT * FROM stg_cash_flow""")
add("g2_union_checks",
    lambda t: D.union_all(
        Q.check_table(t["sub"], "sub", [Q.not_null("fy"), Q.not_null("fp")]),
        Q.check_table(t["num"], "num", [Q.not_null("value")])),
    """SELECT 'not_null' AS "check", 'sub' AS "table", 'fy' AS "column", count(*) failures FROM sub WHERE fy IS NULL
    UNION ALL SELECT 'not_null', 'sub', 'fp', count(*) FROM sub WHERE fp IS NULL
    UNION ALL SELECT 'not_null', 'num', 'value', count(*) FROM num WHERE value IS NULL""")

# ---- H: nested data --------------------------------------------------------------

add("h1_flatten_documents",
    lambda t: nested.flatten_documents(P.filing_documents(t)),
    "SELECT adsh, symbol, data_type, label, concept, info, unit, value FROM doc_fact WHERE data_type IN ('bs', 'cf')")
add_direct("h1_flatten_variant",
    lambda spark, d: flatten_variants(_variants(spark, d)),
    """SELECT year(h.startDate) || 'q' || quarter(h.startDate) period_folder, d.symbol, data_type, label, concept,
    info, unit, value FROM doc_fact d JOIN status h ON h.adsh = d.adsh WHERE data_type IN ('bs', 'cf')""")
add_direct("h2_variant_metadata",
    lambda spark, d: variant_metadata(_variants(spark, d)),
    """SELECT year(startDate) || 'q' || quarter(startDate) period_folder, * FROM meta""")
add("h2_document_metadata",
    lambda t: nested.document_metadata(P.filing_documents(t)),
    "SELECT adsh, startDate, endDate, year, quarter, symbol, name, country, city FROM status WHERE status = 'ok'")


def _json_round_trip(t) -> DataFrame:
    text = P.filing_documents(t).select("adsh", F.to_json(F.struct(*DOC_HEADER, "data")).alias("json"))
    parsed = text.select("adsh", F.from_json("json", DOC_SCHEMA).alias("d")).select("adsh", "d.*")
    return nested.flatten_documents(parsed, DOCUMENT_PARTS)


add("h3_document_json", _json_round_trip, _DOC_ROWS)

# ---- Q: data quality ---------------------------------------------------------------


def _failures(check: str, table: str, column: str, condition: str, source: str | None = None) -> str:
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"count(*) failures FROM {source or table} WHERE {condition}")


add("q1_not_null",
    lambda t: Q.check_table(t["sub"], "sub", [Q.not_null(c) for c in ("adsh", "cik", "fy", "fp")]),
    " UNION ALL ".join(_failures("not_null", "sub", c, f"{c} IS NULL") for c in ("adsh", "cik", "fy", "fp")))
add("q2_not_null_where",
    lambda t: Q.check_table(t["num"], "num", [
        Q.not_null("value", ~F.col("tag").isin("text_only_tags") & F.col("value").isNotNull()),
        Q.not_null("value", F.col("uom") == "EUR")]),
    _failures("not_null", "num", "value", "tag NOT IN ('text_only_tags') AND value IS NOT NULL AND value IS NULL")
    + " UNION ALL " + _failures("not_null", "num", "value", "uom = 'EUR' AND value IS NULL"))
add("q3_accepted_values",
    lambda t: D.union_all(
        Q.check_table(t["sub"], "sub", [
            Q.accepted_values("fp", FISCAL_PERIODS, F.col("fp").isNotNull())]),
        Q.check_table(S.fct_financial_statements(t), "fct", [
            Q.accepted_values("fiscal_period", FISCAL_PERIODS)])),
    _failures("accepted_values", "sub", "fp", f"fp NOT IN {O.text_list(FISCAL_PERIODS)}")
    + " UNION ALL "
    + _failures("accepted_values", "fct", "fiscal_period", f"fiscal_period NOT IN {O.text_list(FISCAL_PERIODS)}"))
add("q4_relationship",
    lambda t: Q.relationship(t["sub"], "cik", t["sym"], "cik", "sub"),
    _failures("relationship", "sub", "cik", "cik IS NOT NULL AND cik NOT IN (SELECT cik FROM sym)"))
add("q5_expression_is_true",
    lambda t: D.union_all(
        Q.check_table(S.fct_financial_statements(t), "fct", [Q.expression_is_true(
            "filing_date", F.col("filing_date").between("1900-01-01", "2100-01-01"))]),
        Q.check_table(t["sub"], "sub", [Q.expression_is_true("filed", F.col("filed") >= F.col("period"))])),
    _failures("expression_is_true", "fct", "filing_date",
              "NOT (filing_date >= DATE '1900-01-01' AND filing_date <= DATE '2100-01-01')")
    + " UNION ALL " + _failures("expression_is_true", "sub", "filed", "NOT filed >= period"))
add("q6_fiscal_period_report",
    lambda t: D.invalid_fiscal_periods(
        t["sub"].select(B.norm_fiscal_period(F.col("fp"), keep_unknown=True).alias("fiscal_period"))),
    f"""SELECT fiscal_period, count(*) record_count FROM (SELECT {O.periods('fp', 'fp')} fiscal_period FROM sub)
    WHERE fiscal_period NOT IN ('Q1', 'Q2', 'Q3', 'Q4', 'FY') GROUP BY fiscal_period""")
add("q7_load_report", lambda t: D.load_counts(P.financial_metadata(t), P.financial_data(t, DOCUMENT_PARTS)),
    """SELECT 'Metadata Count' check_type, count(*) record_count, count(DISTINCT symbol) unique_symbols FROM meta
    UNION ALL SELECT 'Financial Data Count', count(*), count(DISTINCT symbol) FROM doc_fact WHERE data_type <> 'is'""")
add("q8_orphaned_records",
    lambda t: D.union_all(
        C.count_orphans(P.financial_data(t), P.financial_metadata(t))
        .withColumn("check_type", F.lit("Orphaned Records")),
        C.count_orphans(t["sym"].select(B.norm_symbol(F.col("symbol")).alias("symbol")), P.financial_metadata(t))
        .withColumn("check_type", F.lit("Unused Tickers"))),
    """SELECT 'Orphaned Records' check_type, count(*) record_count FROM fdata f
    LEFT JOIN meta m ON f.symbol = m.symbol WHERE m.symbol IS NULL
    UNION ALL SELECT 'Unused Tickers', count(*) FROM sym s WHERE NOT EXISTS (
      SELECT 1 FROM meta m WHERE m.symbol = upper(trim(s.symbol)) AND length(trim(s.symbol)) BETWEEN 1 AND 19)""")
add("q9_table_counts", lambda t: D.table_counts(t),
    " UNION ALL ".join(f"SELECT '{k}' AS \"table\", count(*) row_count FROM {k}" for k in (*RAW_COLUMNS, "sym")))
add("q10_accepted_range",
    lambda t: Q.check_table(
        t["sub"].withColumn("fiscal_year", B.safe_year(F.col("fy"))), "sub", [
            Q.accepted_range("fiscal_year", 1900, 2100),
            Q.accepted_range("fiscal_year", 1996, 2000, F.col("form") == "10-K")]),
    _failures("accepted_range", "sub", "fiscal_year", "CAST(fy AS int) NOT BETWEEN 1900 AND 2100")
    + " UNION ALL " + _failures("accepted_range", "sub", "fiscal_year",
                                "form = '10-K' AND CAST(fy AS int) NOT BETWEEN 1996 AND 2000"))
add("q11_not_empty",
    lambda t: Q.check_table(
        t["num"].withColumn("unit_word", F.regexp_replace("uom", "[A-Z$]", "")), "num",
        [Q.not_empty("uom"), Q.not_empty("unit_word")]),
    _failures("not_empty", "num", "uom", "trim(uom) = ''") + " UNION ALL "
    + _failures("not_empty", "num", "unit_word", "trim(regexp_replace(uom, '[A-Z$]', '', 'g')) = ''"))
add("q12_unique",
    lambda t: D.union_all(
        Q.unique(P.financial_metadata(t), "symbol", "financial_metadata"), Q.unique(t["sub"], "adsh", "sub")),
    """SELECT 'unique' AS "check", 'financial_metadata' AS "table", 'symbol' AS "column", count(*) failures
    FROM (SELECT symbol FROM meta GROUP BY symbol HAVING count(*) > 1)
    UNION ALL SELECT 'unique', 'sub', 'adsh', count(*) FROM (SELECT adsh FROM sub GROUP BY adsh HAVING count(*) > 1)""")


def _declared() -> str:
    parts = []
    for table, columns in K.SOURCE_NOT_NULL.items():
        parts += [_failures("not_null", table, c, f"{c} IS NULL") for c in columns]
    parts.append(_failures("not_null", "num", "value",
                           "tag NOT IN ('text_only_tags') AND value IS NOT NULL AND value IS NULL"))
    outside = f"fiscal_period NOT IN {O.text_list(FISCAL_PERIODS)}"
    for name in ("stg_balance_sheet", "stg_income_statement", "stg_cash_flow"):
        parts.append(_failures("not_null", name, "company_symbol", "company_symbol IS NULL"))
        parts.append(_failures("accepted_values", name, "fiscal_period", outside))
    for name, source, columns in (("fct_financial_statements", "fct", K.FACT_NOT_NULL),
                                  ("company_metrics", "metrics", K.METRICS_NOT_NULL)):
        parts += [_failures("not_null", name, c, f"{c} IS NULL", source) for c in columns]
        parts.append(_failures("accepted_values", name, "fiscal_period", outside, source))
    parts.append(_failures("expression_is_true", "fct_financial_statements", "filing_date",
                           "NOT (filing_date BETWEEN DATE '1900-01-01' AND DATE '2100-01-01')", "fct"))
    parts.append(_failures("relationship", "fct_financial_statements", "company_symbol",
                           "company_symbol NOT IN (SELECT cik FROM sub WHERE cik IS NOT NULL)", "fct"))
    return " UNION ALL ".join(parts)


add("q13_all_checks", K.all_checks, _declared())

# ---- M: models -----------------------------------------------------------------------

add("m1_stg_balance_sheet", S.stg_balance_sheet, "SELECT * FROM stg_balance_sheet")
add("m2_stg_income_statement", S.stg_income_statement, "SELECT * FROM stg_income_statement")
add("m3_stg_cash_flow", S.stg_cash_flow, "SELECT * FROM stg_cash_flow")
add("m4_fct_financial_statements", S.fct_financial_statements, "SELECT * FROM fct")
_METRICS_SQL = "SELECT * REPLACE (" + ", ".join(f"round({r}, 6) AS {r}" for r in RATIO_COLUMNS) + ") FROM metrics"


def _facts_among_strangers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts out of staging rows, among them one of every company that files nothing."""
    t = filing_tables(spark, sf_dir)
    staged = S.staging(t)
    customers, orders = (given_table(spark, sf_dir, n) for n in ("customer", "orders"))
    strangers = customers.join(orders, customers.c_custkey == orders.o_custkey, "left_anti").select(
        F.col("c_custkey").cast("string").alias("company_symbol"), F.lit("20200101").alias("filing_date"),
        F.lit("2020").alias("fiscal_year"), F.lit("FY").alias("fiscal_period"), F.col("c_name").alias("metric_name"),
        F.lit("Assets").alias("metric_code"), F.lit("monetary").alias("metric_info"),
        F.lit("USD").alias("measurement_unit"), F.col("c_acctbal").cast("decimal(38,4)").alias("metric_value"),
        F.lit(S.SOURCE_LABELS["balance_sheet"]).alias("source_file"))
    return S.facts_from_staging(staged.unionByName(strangers), t["sub"])


add_direct("m4_facts_from_staging", _facts_among_strangers, "SELECT * FROM fct")
add("m5_company_metrics", lambda t: rounded(S.company_metrics(t), RATIO_COLUMNS), _METRICS_SQL)
add("m5_company_metrics_from_facts",
    lambda t: rounded(S.company_metrics_from_facts(S.fct_financial_statements(t)), RATIO_COLUMNS), _METRICS_SQL)


def _metrics_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics after four loads; a filing and its values come with the same one."""
    t, store = filing_tables(spark, sf_dir), scratch_folder(spark)
    load = F.pmod(F.col("adsh").cast("bigint"), F.lit(4))
    for i in range(4):
        own = {n: t[n].filter(load == i) for n in ("sub", "num")}
        periods.add_period({**own, "tag": t["tag"]}, store, f"2022q{i + 1}")
    return rounded(periods.company_metrics_of_periods(spark, store), RATIO_COLUMNS)


add_direct("m5_metrics_of_periods", _metrics_in_periods, _METRICS_SQL)
add("m6_balance_sheet", S.balance_sheet, "SELECT * FROM balance_sheet")
add("m6_income_statement", S.income_statement, "SELECT * FROM income_statement")
add("m6_cash_flow", S.cash_flow, "SELECT * FROM cash_flow")
add("m7_fact_financials", S.fact_financials, "SELECT * FROM fact_financials")
add("m8_filing_documents",
    lambda t: P.filing_documents(t).select(
        "adsh", *DOC_HEADER, *[F.size(f"data.{p}").alias(f"{p}_facts") for p in DOCUMENT_PARTS]),
    """SELECT s.adsh, startDate, endDate, year, quarter, s.symbol, name, country, city,
    CAST(count(*) FILTER (data_type = 'bs') AS int) bs_facts,
    CAST(count(*) FILTER (data_type = 'cf') AS int) cf_facts,
    CAST(count(*) FILTER (data_type = 'ic') AS int) ic_facts
    FROM status s LEFT JOIN doc_fact d ON d.adsh = s.adsh WHERE s.status = 'ok' GROUP BY ALL""")


def _rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stored without one of their tags first, then brought up to the whole tables."""
    t, store = filing_tables(spark, sf_dir), scratch_folder(spark)
    rewrites.update_documents({**t, "num": t["num"].filter("tag <> 'Assets'")}, store)
    rewrites.update_documents(t, store)
    return nested.flatten_documents(rewrites.current_documents(spark, store), DOCUMENT_PARTS)


add_direct("m8_update_documents", _rewritten, _DOC_ROWS)


def _by_filing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t, root = filing_tables(spark, sf_dir), scratch_folder(spark)
    prefix = f"by_filing_{root[-32:]}_"
    buckets.store_by_filing(t, prefix, root, buckets=8)
    return buckets.tables_by_filing(spark, prefix, tuple(t))


add("m9_financial_metadata", P.financial_metadata, "SELECT * FROM meta")
add("m10_financial_data", P.financial_data, "SELECT * FROM fdata")
add_direct("m10_financial_data_bucketed", lambda spark, d: P.financial_data(_by_filing(spark, d)), "SELECT * FROM fdata")
add_direct("m8_filing_documents_bucketed",
    lambda spark, d: nested.flatten_documents(P.filing_documents(_by_filing(spark, d)), DOCUMENT_PARTS), _DOC_ROWS)
add("m10_financial_data_exact", lambda t: P.financial_data(t, DOCUMENT_PARTS, exact=True),
    """SELECT h.symbol, lower(p.stmt) data_type, n.tag concept, replace(p.plabel, '"', '''') info,
    n.uom unit, CAST(TRY_CAST(n.value AS decimal(28,4)) AS double) AS value
    FROM status h JOIN num n ON n.adsh = h.adsh JOIN first_doc d ON d.tag = n.tag
    JOIN first_pre p ON p.adsh = h.adsh AND p.tag = n.tag
    WHERE h.status = 'ok' AND p.stmt IN ('BS', 'CF', 'IC') AND TRY_CAST(n.value AS decimal(28,4)) IS NOT NULL""")

# ---- N: analyst queries ----------------------------------------------------------------

add("n1_recent_filings", N.recent_filings,
    "SELECT name, form, filed, period FROM sub ORDER BY filed DESC, adsh LIMIT 10")
add("n2_top_companies", N.top_companies,
    "SELECT name, count(*) filing_count FROM sub GROUP BY name ORDER BY filing_count DESC, name LIMIT 10")
add("n3_values_by_tag", N.values_by_tag,
    """SELECT tag, value, name, ddate FROM num n JOIN sub s ON n.adsh = s.adsh
    WHERE tag IN ('Assets', 'Liabilities', 'StockholdersEquity')
    ORDER BY ddate DESC, tag, value NULLS FIRST, name LIMIT 10""")


def _by_two_keys(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t, root = filing_tables(spark, sf_dir), scratch_folder(spark)
    store_by_keys(t["num"], root)
    return {**t, "num": spark.read.parquet(root)}


add_direct("a10_two_key_store", lambda spark, d: _by_two_keys(spark, d)["num"].select(
    "adsh", "tag", "version", "ddate", "qtrs", "uom", "value"),
    "SELECT adsh, tag, version, ddate, qtrs, uom, value FROM num")
add_direct("n3_values_by_tag_two_keys", lambda spark, d: N.values_by_tag(_by_two_keys(spark, d)),
    """SELECT tag, value, name, ddate FROM num n JOIN sub s ON n.adsh = s.adsh
    WHERE tag IN ('Assets', 'Liabilities', 'StockholdersEquity')
    ORDER BY ddate DESC, tag, value NULLS FIRST, name LIMIT 10""")
add("n4_tag_usage", N.tag_usage,
    """SELECT t.tag, t.tlabel, count(*) usage_count FROM tag t JOIN num n ON t.tag = n.tag
    GROUP BY t.tag, t.tlabel ORDER BY usage_count DESC, t.tag, t.tlabel LIMIT 10""")
add("n5_data_points", N.data_points,
    """SELECT m.name, m.country, count(*) data_points FROM meta m JOIN fdata f ON m.symbol = f.symbol
    GROUP BY m.name, m.country ORDER BY data_points DESC, m.name, m.country LIMIT 10""")
add("n6_balance_sheet_analysis", N.balance_sheet_analysis,
    """SELECT m.symbol, m.name, f.concept, f.value, count(*) row_count
    FROM meta m JOIN fdata f ON m.symbol = f.symbol
    WHERE f.data_type = 'bs' AND f.concept IN ('Assets', 'Liabilities', 'StockholdersEquity') GROUP BY ALL""")
add("n7_cash_flow_metrics", N.cash_flow_metrics,
    f"""SELECT m.symbol, m.name, f.concept, f.value, m.year, m.quarter, count(*) row_count
    FROM meta m JOIN fdata f ON m.symbol = f.symbol
    WHERE f.data_type = 'cf' AND f.concept IN {O.text_list(S.STATEMENT_TAGS['cash_flow'])} GROUP BY ALL""")
add("n6_balance_sheet_analysis_rows", lambda t: N.balance_sheet_analysis(t, expand=True),
    """SELECT m.symbol, m.name, f.concept, f.value FROM meta m JOIN fdata f ON m.symbol = f.symbol
    WHERE f.data_type = 'bs' AND f.concept IN ('Assets', 'Liabilities', 'StockholdersEquity')""")
add("n7_cash_flow_metrics_rows", lambda t: N.cash_flow_metrics(t, expand=True),
    f"""SELECT m.symbol, m.name, f.concept, f.value, m.year, m.quarter
    FROM meta m JOIN fdata f ON m.symbol = f.symbol
    WHERE f.data_type = 'cf' AND f.concept IN {O.text_list(S.STATEMENT_TAGS['cash_flow'])}""")
add("n8_company_health", N.company_health,
    """SELECT m.symbol, m.name,
    sum(CASE WHEN f.data_type = 'bs' AND f.concept = 'Assets' THEN f.value ELSE 0 END) total_assets,
    sum(CASE WHEN f.data_type = 'bs' AND f.concept = 'Liabilities' THEN f.value ELSE 0 END) total_liabilities,
    sum(CASE WHEN f.data_type = 'cf' AND f.concept = 'NetCashProvidedByUsedInOperatingActivities'
      THEN f.value ELSE 0 END) operating_cash_flow
    FROM meta m JOIN fdata f ON m.symbol = f.symbol GROUP BY m.symbol, m.name HAVING total_assets > 0""")
add("n9_quarterly_trends", N.quarterly_trends,
    """SELECT m.symbol, m.name, m.year, m.quarter,
    max(CASE WHEN f.concept = 'Revenues' THEN f.value END) revenue,
    max(CASE WHEN f.concept = 'NetIncomeLoss' THEN f.value END) net_income
    FROM meta m JOIN fdata f ON m.symbol = f.symbol GROUP BY m.symbol, m.name, m.year, m.quarter""")
add("n9_quarterly_trends_income",
    lambda t: N.quarterly_trends(t, parts=("is",), data_type="is"),
    """SELECT m.symbol, m.name, m.year, m.quarter,
    CAST(max(CASE WHEN f.concept = 'Revenues' THEN f.value END) AS double) revenue,
    CAST(max(CASE WHEN f.concept = 'NetIncomeLoss' THEN f.value END) AS double) net_income
    FROM meta m JOIN doc_fact f ON m.symbol = f.symbol WHERE f.data_type = 'is'
    GROUP BY m.symbol, m.name, m.year, m.quarter""")
add("n10_balance_sheet_key_metrics", N.balance_sheet_key_metrics,
    f"""SELECT symbol, concept, {_STATS} FROM balance_sheet WHERE concept IN ('Assets', 'Liabilities', 'StockholdersEquity')
    GROUP BY symbol, concept ORDER BY symbol, concept LIMIT 20""")
_LATEST = """SELECT symbol, concept, value, filing_date FROM {0} WHERE concept IN {1}
ORDER BY filing_date DESC, symbol, concept, value, label, unit, fiscal_year NULLS FIRST,
 fiscal_period NULLS FIRST LIMIT 20"""
add("n11_income_statement_analysis", N.income_statement_analysis,
    _LATEST.format("income_statement", O.text_list(N.INCOME_CONCEPTS)))
add("n12_cash_flow_indicators", N.cash_flow_indicators,
    _LATEST.format("cash_flow", O.text_list(S.STATEMENT_TAGS["cash_flow"])))
add("n13_financial_overview", N.financial_overview,
    "SELECT {0} FROM fact_financials ORDER BY {0} LIMIT 20".format(", ".join(N.OVERVIEW_COLUMNS)))
add("n14_health_indicators", lambda t: rounded(N.health_indicators(t), _HEALTH, 2),
    f"{_ROUNDED} FROM ({_FANOUT}) ORDER BY total_assets DESC, symbol LIMIT 15")


def _alone(name: str, tag: str, column: str) -> str:
    return (f"(SELECT symbol, CAST(sum(CASE WHEN concept = '{tag}' THEN CAST(value AS decimal(28,4)) "
            f"ELSE 0 END) AS double) {column} FROM {name} GROUP BY symbol)")


add("n14_health_indicators_corrected",
    lambda t: rounded(N.health_indicators(t, fan_out=False), _HEALTH, 2),
    f"""{_ROUNDED} FROM (SELECT a.symbol, total_assets, total_liabilities,
      coalesce(operating_cash_flow, 0) operating_cash_flow, coalesce(revenue, 0) revenue
    FROM {_alone('balance_sheet', 'Assets', 'total_assets')} a
    JOIN {_alone('balance_sheet', 'Liabilities', 'total_liabilities')} l USING (symbol)
    LEFT JOIN {_alone('cash_flow', N.OPERATING_CASH_FLOW, 'operating_cash_flow')} c USING (symbol)
    LEFT JOIN {_alone('income_statement', 'Revenues', 'revenue')} i USING (symbol))
    ORDER BY total_assets DESC, symbol LIMIT 15""")
add_direct("n15_ad_hoc_sql",
    lambda spark, d: N.run_sql(spark, filing_tables(spark, d), """
    SELECT s.form, n.tag, count(*) AS row_count, count(n.value) AS filled FROM num n
    JOIN sub s ON n.adsh = s.adsh GROUP BY s.form, n.tag"""),
    """SELECT s.form, n.tag, count(*) AS row_count, count(n.value) AS filled FROM num n
    JOIN sub s ON n.adsh = s.adsh GROUP BY s.form, n.tag""")
