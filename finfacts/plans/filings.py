"""Filing documents and the two document tables.

``tables`` maps ``sub``, ``num``, ``tag``, ``pre`` and ``sym`` to raw DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finfacts.functions import (
    clean_text, doc_quarter, doc_value, doc_year, norm_symbol, parse_period,
    period_end, route_stmt,
)
from finfacts.operators.joins import (
    first_by, lookup_presentation, lookup_symbol, lookup_tag_doc,
)
from finfacts.operators.nested import assemble_documents, document_metadata, flatten_documents
from finfacts.plans.statements import Tables
from finfacts.schema import DOC_HEADER, DOCUMENT_PARTS, LOADED_PARTS, PERIOD_MONTHS

ACCEPTED = "ok"


def _with_ticker(sub: DataFrame, sym: DataFrame) -> DataFrame:
    """Filings with the normalized first ticker of their company; ``_listed`` if it has any."""
    tickers = lookup_symbol(sym).select(
        "cik", norm_symbol(F.col("symbol")).alias("symbol"), F.lit(True).alias("_listed")
    )
    return sub.join(tickers, "cik", "left")


def _header() -> list[Column]:
    """Document header out of the columns of a filing with ticker."""
    start, quarter = parse_period(F.col("period")), doc_quarter(F.col("fp"))
    return [
        start.alias("startDate"), period_end(start, quarter).alias("endDate"),
        doc_year(F.col("fy")).alias("year"), quarter.alias("quarter"), F.col("symbol"),
        clean_text(F.col("name")).alias("name"), clean_text(F.col("countryma")).alias("country"),
        clean_text(F.col("cityma")).alias("city"),
    ]


def filing_status(sub: DataFrame, sym: DataFrame) -> DataFrame:
    """Document header of every filing with a ``status``: ok or the first reason to reject it."""
    header = _with_ticker(sub, sym).select("adsh", *_header(), "_listed")
    reason = (
        F.when(F.col("startDate").isNull(), "bad period")
        .when(F.col("year").isNull(), "bad year")
        .when(F.col("endDate").isNull(), "bad quarter")
        .when(F.col("_listed").isNull(), "no symbol")
        .when(F.col("symbol").isNull(), "bad symbol")
        .otherwise(ACCEPTED)
    )
    return header.withColumn("status", reason).drop("_listed")


def filing_status_counts(sub: DataFrame, sym: DataFrame) -> DataFrame:
    """Filings per status."""
    return filing_status(sub, sym).groupBy("status").agg(F.count("*").alias("filings"))


def filing_headers(sub: DataFrame, sym: DataFrame) -> DataFrame:
    """Document headers of the accepted filings: those with status ok.

    Written as plain conditions on the raw columns, which filter the filings
    before the ticker join.
    """
    codes = [code for group in PERIOD_MONTHS.values() for code in group]
    kept = sub.filter(
        parse_period(F.col("period")).isNotNull() & doc_year(F.col("fy")).isNotNull()
        & doc_quarter(F.col("fp")).isin(*codes)
    )
    listed = _with_ticker(kept, sym).filter(F.col("symbol").isNotNull())
    return listed.select("adsh", *_header())


def _placements(pre: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Where a filing shows each tag: document part and caption."""
    placed = lookup_presentation(pre).select(
        "adsh", "tag", route_stmt(F.col("stmt"), parts).alias("stmt"),
        clean_text(F.col("plabel"), label=True).alias("info"),
    )
    return placed.filter(F.col("stmt").isNotNull())


def _numeric(num: DataFrame, exact: bool) -> DataFrame:
    values = num.select(
        "adsh", "tag", F.col("uom").alias("unit"),
        doc_value(F.col("value"), exact).alias("value"),
    )
    return values.filter(F.col("value").isNotNull())


def document_facts(
    tables: Tables, headers: DataFrame, parts: Sequence[str] = DOCUMENT_PARTS,
    exact: bool = False,
) -> DataFrame:
    """Distinct facts of the filings in ``headers`` with the number of ``copies`` of each.

    Tag texts and captions are attached to the presentation rows, one per filing and tag; equal values are counted before the first shuffle of ``num``.
    """
    docs = lookup_tag_doc(tables["tag"]).select(
        "tag", clean_text(F.col("doc")).alias("label")
    )
    placed = (
        _placements(tables["pre"], parts)
        .join(headers, "adsh").join(docs, "tag")
    )
    values = _numeric(tables["num"], exact).groupBy("adsh", "tag", "unit", "value").agg(
        F.count("*").alias("copies")
    )
    return values.join(placed, ["adsh", "tag"]).select(
        *headers.columns, "stmt", "label", F.col("tag").alias("concept"), "info", "unit",
        "value", "copies",
    )


def filing_documents(
    tables: Tables, parts: Sequence[str] = DOCUMENT_PARTS, exact: bool = False,
) -> DataFrame:
    """One nested document per accepted filing."""
    if not set(parts) <= set(DOCUMENT_PARTS):
        raise ValueError(f"document parts are {DOCUMENT_PARTS}, not {tuple(parts)}")
    headers = filing_headers(tables["sub"], tables["sym"])
    if "period_folder" in tables["sub"].columns:
        folders = first_by(tables["sub"], ["adsh"], [], ["period_folder"])
        headers = headers.join(folders, "adsh")
    facts = document_facts(tables, headers.select("adsh"), parts, exact)
    return assemble_documents(headers, facts)


def metadata_table(
    headers: DataFrame, ids: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Metadata columns of documents or headers; ``ids`` adds a key of the natural columns."""
    table = headers.select(*keep, *DOC_HEADER)
    return table.withColumn("id", F.xxhash64(*DOC_HEADER)) if ids else table


def financial_metadata(tables: Tables, ids: bool = False) -> DataFrame:
    """One row per accepted filing, without building its document."""
    return metadata_table(filing_headers(tables["sub"], tables["sym"]), ids)


def data_table(
    facts: DataFrame, ids: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Data columns of flattened facts; ``ids`` adds a key of the natural columns."""
    table = facts.select(
        *keep, "symbol", "data_type", "concept", "info", "unit",
        F.col("value").cast("double").alias("value"),
    )
    return table.withColumn("id", F.xxhash64(*table.columns)) if ids else table


def placed_tags(
    tables: Tables, parts: Sequence[str] = LOADED_PARTS, tags: Sequence[str] | None = None
) -> DataFrame:
    """Tags, or some of them, shown by accepted filings: ``adsh, tag, symbol, data_type, info``, one row each."""
    listed = F.lit(True) if tags is None else F.col("tag").isin(*tags)
    known = tables["tag"].filter(listed).select("tag").distinct()
    headers = filing_headers(tables["sub"], tables["sym"]).select("adsh", "symbol")
    return (
        _placements(tables["pre"].filter(listed), parts).join(known, "tag", "left_semi").join(headers, "adsh")
        .withColumnRenamed("stmt", "data_type")
    )


def fact_groups(
    tables: Tables, aggregates: Sequence[Column], parts: Sequence[str] = LOADED_PARTS,
    tags: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregates of the document values per filing and tag, with the tag's placement.

    The values are reduced before their only shuffle, whatever filing or tag holds most.
    """
    num = tables["num"] if tags is None else tables["num"].filter(F.col("tag").isin(*tags))
    reduced = _numeric(num, exact=False).groupBy("adsh", "tag").agg(*aggregates)
    return reduced.join(placed_tags(tables, parts, tags), ["adsh", "tag"]).withColumnRenamed(
        "tag", "concept"
    )


def financial_data(
    tables: Tables, parts: Sequence[str] = LOADED_PARTS, exact: bool = False,
    ids: bool = False, tags: Sequence[str] | None = None,
) -> DataFrame:
    """One row per loaded fact, or per fact of some tags, without building documents.

    Everything but the value comes from the presentation rows, so ``num`` is
    shuffled once, by filing and tag. A list of tags reaches all scans.
    """
    placed = placed_tags(tables, parts, tags)
    num = tables["num"] if tags is None else tables["num"].filter(F.col("tag").isin(*tags))
    facts = _numeric(num, exact).join(placed, ["adsh", "tag"]).withColumnRenamed(
        "tag", "concept"
    )
    return data_table(facts, ids)


def document_tables(
    docs: DataFrame, parts: Sequence[str] = LOADED_PARTS, ids: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Metadata and data tables out of documents."""
    return (
        metadata_table(document_metadata(docs), ids),
        data_table(flatten_documents(docs, parts), ids),
    )
