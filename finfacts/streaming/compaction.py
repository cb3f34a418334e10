"""Merging of landed batches: fewer files, the same rows for readers and restarts.

A landed table has a folder for each period and batch. Compaction writes all batches but
the last, which a restart may repeat, as one folder per period beside them, and then notes
up to which batch it got. Readers take the merged rows up to there and the batches behind;
until the note is written they see what they saw. Folders that no note since the one before
needs are removed by the next compaction, so a reader that has begun can end.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.sources.sinks import remove_folder, save_model


def _notes(spark: SparkSession, dst: str, name: str) -> list[int]:
    """The batches up to which the table was merged, ascending: one number for each compaction."""
    try:
        rows = spark.read.schema("upto bigint").parquet(f"{dst}/{name}_merged_upto")
        return sorted(r["upto"] for r in rows.distinct().collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _texts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("period_folder", F.col("period_folder").cast("string"))


def _merged(spark: SparkSession, dst: str, name: str, upto: int) -> DataFrame:
    return _texts(spark.read.parquet(f"{dst}/{name}_merged/{upto}"))


def landed_table(spark: SparkSession, dst: str, name: str) -> DataFrame:
    """The rows of a landed table, merged or not, with ``period_folder`` and ``ingest_batch``."""
    rows, notes = _texts(spark.read.parquet(f"{dst}/{name}")), _notes(spark, dst, name)
    if not notes:
        return rows
    behind = rows.filter(F.col("ingest_batch") > notes[-1])
    return _merged(spark, dst, name, notes[-1]).unionByName(behind)


def compact_landed(spark: SparkSession, dst: str, name: str) -> int | None:
    """Merge the landed batches of a table but the last; the batch it got to, or None if there was nothing to do.

    Each row keeps its ``ingest_batch``. Not to be run twice at once for a table.
    """
    notes = _notes(spark, dst, name)
    last = spark.read.parquet(f"{dst}/{name}").agg(F.max("ingest_batch")).first()[0]
    upto = last - 1 if last is not None else -1
    if upto < 0 or notes and upto <= notes[-1]:
        return None
    rows = landed_table(spark, dst, name).filter(F.col("ingest_batch") <= upto)
    save_model(rows, f"{dst}/{name}_merged/{upto}", partition_by=["period_folder"], mode="replace")
    spark.createDataFrame([(upto,)], "upto bigint").coalesce(1).write.mode("append").parquet(
        f"{dst}/{name}_merged_upto")
    if notes:
        _remove(spark, dst, name, notes)
    return upto


def _remove(spark: SparkSession, dst: str, name: str, notes: list[int]) -> None:
    """Drop the batches that the last note before covers, and merged folders older than that."""
    folders = spark.read.parquet(f"{dst}/{name}").filter(F.col("ingest_batch") <= notes[-1]).select(
        F.col("period_folder").cast("string"), "ingest_batch").distinct()
    # One row for each folder that goes.
    for r in folders.collect():
        remove_folder(spark, f"{dst}/{name}/period_folder={r['period_folder']}/ingest_batch={r['ingest_batch']}")
    for upto in notes[:-1]:
        remove_folder(spark, f"{dst}/{name}_merged/{upto}")
