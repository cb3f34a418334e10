"""Incremental landing of filing documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.operators.nested import document_metadata, flatten_documents
from finfacts.plans.filings import data_table, metadata_table
from finfacts.schema import LOADED_PARTS
from finfacts.sources.documents import document_paths, parse_documents
from finfacts.sources.raw import period_of


def document_stream(
    spark: SparkSession, src: str, form: str = "lines", files_per_batch: int | None = None
) -> DataFrame:
    """Streaming documents of all period folders under ``src``."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = document_paths(src, None, form)[0]
    texts = reader.text(path, wholetext=form == "files").select(
        "value", period_of(F.col("_metadata.file_path")).alias("period_folder")
    )
    return parse_documents(texts)


def _land(batch: DataFrame, batch_id: int, dst: str, parts: Sequence[str]) -> None:
    """Write the tables of one batch; a repeated batch replaces its own rows only."""
    batch.persist()
    try:
        _write_tables(batch, batch_id, dst, parts)
    finally:
        batch.unpersist()


def _write_tables(batch: DataFrame, batch_id: int, dst: str, parts: Sequence[str]) -> None:
    tables = {
        "financial_metadata": metadata_table(document_metadata(batch), keep=["period_folder"]),
        "financial_data": data_table(flatten_documents(batch, parts), keep=["period_folder"]),
    }
    for name, rows in tables.items():
        (
            rows.withColumn("ingest_batch", F.lit(batch_id)).hint("rebalance", "period_folder")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("period_folder", "ingest_batch").parquet(f"{dst}/{name}")
        )


def _claim(spark: SparkSession, dst: str, checkpoint: str) -> None:
    """Note the checkpoint that fills ``dst``; batch numbers of another one would mix with its own."""
    mark = f"{dst}/landed_by"
    try:
        owner = spark.read.text(mark).first()
    except AnalysisException:
        owner = None
    if owner is None:
        # A write that was cut short has left an empty mark.
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.mode("overwrite").text(mark)
    elif owner["value"] != checkpoint:
        raise ValueError(f"{dst} is filled by the checkpoint {owner['value']}; use it or another target")


def ingest_documents(
    spark: SparkSession, src: str, dst: str, checkpoint: str,
    parts: Sequence[str] = LOADED_PARTS, form: str = "lines",
    files_per_batch: int | None = None,
) -> None:
    """Load the documents that arrived since the last run into the two document tables.

    The checkpoint remembers the files already loaded, so each is loaded once. It
    and ``dst`` belong into storage that all executors share. A ``dst`` that another
    checkpoint fills is an error, as its rows would be loaded again.
    """
    _claim(spark, dst, checkpoint)
    query = (
        document_stream(spark, src, form, files_per_batch).writeStream
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: _land(batch, batch_id, dst, parts))
        .start()
    )
    query.awaitTermination()
