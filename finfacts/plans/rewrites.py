"""Filing documents that are written again only where their filing has changed.

Every filing has a digest of its header and of all rows its document is made of, in no
order: counts and sums of hashes, so a row more, less or changed shows. Documents of
filings whose digest is not the stored one are assembled and appended; an index says
which version of a filing counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finfacts.operators.joins import fits_broadcast, lookup_tag_doc
from finfacts.plans.filings import filing_documents, filing_headers
from finfacts.plans.statements import Tables
from finfacts.schema import DOC_HEADER, DOCUMENT_PARTS
from finfacts.sources.sinks import shuffles_freed

_HALF = 0xFFFFFFFF
SUMS = ("n", "low", "high")


def _sums(rows: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Per filing the number of rows and the sums of both halves of their hashes."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    hashed = rows.select("adsh", F.xxhash64(*values, *[v.isNull() for v in values]).alias("h"))
    return hashed.groupBy("adsh").agg(
        F.count("*").alias("n"), F.sum(F.col("h").bitwiseAND(F.lit(_HALF))).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"))


def filing_digests(tables: Tables) -> DataFrame:
    """``adsh`` and ``digest`` of every accepted filing: its header, values, presentation and tag texts."""
    headers = filing_headers(tables["sub"], tables["sym"])
    # Texts of tags come in by their hash.
    docs = lookup_tag_doc(tables["tag"]).select("tag", F.xxhash64("doc").alias("doc"))
    shown = tables["pre"].select("adsh", "report", "line", "stmt", "tag", "plabel").join(docs, "tag", "left")
    parts = {
        "num": _sums(tables["num"], ["tag", "uom", "value"]),
        "pre": _sums(shown, ["report", "line", "stmt", "tag", "plabel", "doc"]),
    }
    rows = headers.select("adsh", F.xxhash64(
        *DOC_HEADER, *[F.col(c).isNull() for c in DOC_HEADER]).alias("header"))
    for name, sums in parts.items():
        rows = rows.join(sums.select("adsh", F.struct(*SUMS).alias(name)), "adsh", "left")
    return rows.select("adsh", F.sha2(F.to_json(F.struct("header", *parts)), 256).alias("digest"))


def document_index(spark: SparkSession, store: str) -> DataFrame | None:
    """The last ``digest`` and ``load`` of every filing ever stored; a filing that is gone has no digest."""
    try:
        rows = spark.read.parquet(f"{store}/index")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    last = F.max(F.struct("load", "digest")).alias("last")
    return rows.groupBy("adsh").agg(last).select("adsh", "last.digest", "last.load")


def _some_filings(tables: Tables, wanted: DataFrame) -> Tables:
    """The tables cut down to the filings in ``wanted``.

    A document takes only rows of filings in ``sub``, so values and presentation rows are
    cut down only where that needs no shuffle of theirs: if few filings are wanted.
    """
    few = fits_broadcast(wanted)
    cut = ("sub", "num", "pre") if few else ("sub",)
    wanted = F.broadcast(wanted) if few else wanted
    return {**tables, **{n: tables[n].join(wanted, "adsh", "left_semi") for n in cut}}


def update_documents(
    tables: Tables, store: str, parts: Sequence[str] = DOCUMENT_PARTS, exact: bool = False
) -> int:
    """Bring the documents under ``store`` up to the tables; returns how many were written.

    The documents are written before the index that names them, so an update that fails
    midway shows nothing, and is made good by the next.
    """
    with shuffles_freed(tables["sub"].sparkSession):
        return _update(tables, store, parts, exact)


def _update(tables: Tables, store: str, parts: Sequence[str], exact: bool) -> int:
    spark = tables["sub"].sparkSession
    known, now = document_index(spark, store), filing_digests(tables)
    load = 0 if known is None else (known.agg(F.max("load")).first()[0] or 0) + 1
    changed = now if known is None else now.join(known, ["adsh", "digest"], "left_anti")
    pending = f"{store}/pending/load={load}"
    changed.write.mode("overwrite").parquet(pending)
    changed = spark.read.parquet(pending)
    docs = filing_documents(_some_filings(tables, changed.select("adsh")), parts, exact)
    docs.write.mode("overwrite").option("compression", "zstd").parquet(f"{store}/documents/load={load}")
    marks = changed.select("adsh", "digest")
    if known is not None:
        gone = known.filter("digest IS NOT NULL").join(now, "adsh", "left_anti")
        marks = marks.union(gone.select("adsh", F.lit(None).cast("string")))
    marks.withColumn("load", F.lit(load)).write.mode("append").parquet(f"{store}/index")
    return changed.count()


def current_documents(spark: SparkSession, store: str) -> DataFrame:
    """The documents of all filings in the version that counts."""
    index = document_index(spark, store).filter("digest IS NOT NULL").select("adsh", "load")
    return spark.read.parquet(f"{store}/documents").join(index, ["adsh", "load"]).drop("load")
