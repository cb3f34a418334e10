"""Filing documents: assembly of facts into arrays, and flattening back to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from finfacts.schema import DOC_HEADER, DOCUMENT_PARTS, LOADED_PARTS

FACT = ("label", "concept", "info", "unit", "value")


def assemble_documents(headers: DataFrame, facts: DataFrame) -> DataFrame:
    """One document for every filing in ``headers`` (key ``adsh``), whatever its size.

    ``facts`` holds distinct ``adsh, stmt, label, concept, info, unit, value`` rows and how
    many ``copies`` of each exist. A filing without facts has empty arrays.
    """
    item = F.struct("stmt", *FACT, F.col("copies").cast("int").alias("_copies"))
    arrays = facts.groupBy("adsh").agg(
        F.sort_array(F.collect_list(item)).alias("_facts")
    ).select("adsh", *[_write_out("_facts", p).alias(p) for p in DOCUMENT_PARTS])
    data = F.struct(*[F.coalesce(F.col(p), F.array()).alias(p) for p in DOCUMENT_PARTS])
    return headers.join(arrays, "adsh", "left").select(
        *[c for c in headers.columns if c not in DOC_HEADER], *DOC_HEADER, data.alias("data"),
    )


def _write_out(column: str, part: str) -> Column:
    """Facts of one document part, each repeated as often as it has copies."""
    chosen = F.filter(column, lambda f: f["stmt"] == part)
    return F.flatten(F.transform(chosen, lambda f: F.array_repeat(
        F.struct(*[f[name].alias(name) for name in FACT]), f["_copies"]
    )))


def flatten_documents(docs: DataFrame, parts: Sequence[str] = LOADED_PARTS) -> DataFrame:
    """One row per fact of the chosen arrays, tagged by ``data_type``; empty arrays give no row."""
    keep = [c for c in docs.columns if c not in DOC_HEADER and c != "data"]
    tagged = F.array(*[
        F.struct(F.lit(p).alias("data_type"), F.col(f"data.{p}").alias("facts")) for p in parts
    ])
    sections = docs.select(*keep, "symbol", F.explode(tagged).alias("_s"))
    return sections.select(
        *keep, "symbol", F.col("_s.data_type").alias("data_type"), F.inline("_s.facts")
    )


def document_metadata(docs: DataFrame) -> DataFrame:
    """Header columns of each document."""
    keep = [c for c in docs.columns if c not in DOC_HEADER and c != "data"]
    return docs.select(*keep, *DOC_HEADER)
