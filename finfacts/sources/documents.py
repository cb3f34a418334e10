"""Filing documents as JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.schema import DOC_HEADER, document_schema
from finfacts.sources.raw import period_of, require


def document_paths(root: str, periods: Sequence[str] | None, form: str) -> list[str]:
    """Paths of the wanted periods: one file per document, or JSON lines per period."""
    if form not in ("lines", "files"):
        raise ValueError(f"form is 'lines' or 'files', not {form!r}")
    folder = "period_folder={}" if form == "lines" else "{}"
    return [f"{root.rstrip('/')}/{folder.format(p)}/*.json" for p in (periods or ["*"])]


def parse_documents(texts: DataFrame, on_error: str = "skip", exact: bool = False) -> DataFrame:
    """Documents out of JSON texts in ``value``; keeps the text's ``period_folder``.

    Works on batch and streaming input. Invalid UTF-8 is replaced. A text that is
    no JSON object of the declared shape is skipped, or fails the job under ``abort``.
    """
    text = F.make_valid_utf8("value")
    schema = document_schema(exact) + ", _bad string"
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_bad"})
    # Exploding a single element keeps the parse out of the filter: it runs once per text.
    docs = texts.filter(F.trim("value") != "").select(
        "period_folder", text.rlike(r"^\s*\{").alias("_object"), F.explode(F.array(parsed)).alias("d")
    )
    valid = F.col("_object") & F.col("d").isNotNull() & F.col("d._bad").isNull()
    kept = require(docs, valid, on_error, "a document does not fit the declared schema")
    return kept.select(
        "period_folder", *[F.col(f"d.{c}").alias(c) for c in (*DOC_HEADER, "data")]
    )


def read_documents(
    spark: SparkSession, root: str, periods: Sequence[str] | None = None,
    form: str = "lines", on_error: str = "skip", exact: bool = False,
) -> DataFrame:
    """Documents under ``root``; only the wanted period folders are listed."""
    texts = (
        spark.read.text(document_paths(root, periods, form), wholetext=form == "files")
        .select("value", period_of(F.col("_metadata.file_path")).alias("period_folder"))
    )
    return parse_documents(texts, on_error, exact)


def write_documents(docs: DataFrame, dst: str, period: str | None = None) -> None:
    """Write documents as JSON lines per period; NULL fields are kept.

    The period is a column of the documents or given. A period replaces its
    earlier documents and leaves other periods alone.
    """
    if period is not None:
        docs = docs.withColumn("period_folder", F.lit(period))
    (
        docs.select("period_folder", *DOC_HEADER, "data")
        .hint("rebalance", "period_folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False).partitionBy("period_folder").json(dst)
    )
