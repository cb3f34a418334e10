"""Documents in a VARIANT column: lateral flattening by path, and header fields.

No schema of the whole document is declared. A field that a document lacks, or holds in
another type, is NULL in that row only; fields that no path names stay in the document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from finfacts.functions import doc_field
from finfacts.schema import DOC_HEADER, LOADED_PARTS

HEADER_TYPES = dict.fromkeys(DOC_HEADER, "string") | {"startDate": "date", "endDate": "date", "year": "int"}


def explode_path(docs: DataFrame, path: str, fields: Mapping[str, tuple[str, str]], doc: str = "doc") -> DataFrame:
    """One row for every element of the array at ``path`` (empty: the document), with ``fields``: name to (path, type).

    All columns of ``docs`` but the document stay. Whatever is no array gives no row, and
    an element without any of the fields none either.
    """
    spark = docs.sparkSession
    keep = [F.col(f"`{c}`") for c in docs.columns if c != doc]
    array = F.try_variant_get(F.col(f"`{doc}`").outer(), f"$.{path}" if path else "$", "variant")
    exploded = docs.lateralJoin(spark.tvf.variant_explode(array))
    # Elements of an object have keys, those of an array only places.
    elements = exploded.filter(F.col("key").isNull()).select(*keep, *[
        doc_field(F.col("value"), p, kind).alias(name) for name, (p, kind) in fields.items()])
    return elements.filter(F.coalesce(*[F.col(f"`{n}`").cast("string") for n in fields]).isNotNull())


def flatten_variants(docs: DataFrame, parts: Sequence[str] = LOADED_PARTS, exact: bool = False) -> DataFrame:
    """One row per fact of the chosen arrays, tagged by ``data_type``, out of documents in ``doc``.

    The same rows as ``flatten_documents`` gives for documents of the declared shape.
    """
    value = "decimal(28,4)" if exact else "bigint"
    fields = {n: (n, "string") for n in ("label", "concept", "info", "unit")} | {"value": ("value", value)}
    keep = [c for c in docs.columns if c != "doc"]
    # One pass over the documents: the parts are elements too.
    sections = docs.withColumn("symbol", doc_field(F.col("doc"), "symbol", "string")).select(
        *keep, "symbol", F.explode(F.array(*[
            F.struct(F.lit(p).alias("data_type"), F.try_variant_get("doc", f"$.data.{p}", "variant").alias("doc"))
            for p in parts])).alias("_s")
    ).select(*keep, "symbol", F.col("_s.data_type").alias("data_type"), F.col("_s.doc").alias("doc"))
    return explode_path(sections, "", fields)


def variant_metadata(docs: DataFrame) -> DataFrame:
    """Header columns of documents in ``doc``."""
    keep = [c for c in docs.columns if c != "doc"]
    return docs.select(*keep, *[doc_field(F.col("doc"), c, kind).alias(c) for c, kind in HEADER_TYPES.items()])
