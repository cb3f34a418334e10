"""Loads that remember: files taken once, refused rows kept aside, documents landed as VARIANT.

A load lists the files of its paths, leaves out those that the history of its target holds
with the same size and modification time, and reads the others in one scan. That scan
writes all rows: those that fit, and the refused ones with their file and reason beside
them. Only then are the files noted in the history, so a load that fails midway leaves
nothing behind that a reader sees, and the next one takes its files again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from finfacts.schema import RAW_COLUMNS
from finfacts.sources.documents import document_paths
from finfacts.sources.raw import misfit, period_of, raw_csv, raw_paths

HISTORY_SCHEMA = "file string, size bigint, modified timestamp, load_id string"


class LoadResult(NamedTuple):
    """What one load did; the numbers were observed while its rows were written."""

    load_id: str | None
    files: int
    rows_read: int
    rows_kept: int
    rows_refused: int


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, file, size, modified`` of the files under ``paths``; contents are not read."""
    return spark.read.format("binaryFile").load(list(paths)).select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A stored table, or None if nothing is there yet."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def load_history(spark: SparkSession, dst: str) -> DataFrame:
    """Every file taken into ``dst``: ``file, size, modified, load_id``; one row for each time it was."""
    found = _stored(spark, f"{dst}/history", HISTORY_SCHEMA)
    return spark.createDataFrame([], HISTORY_SCHEMA) if found is None else found


def pending_files(spark: SparkSession, paths: Sequence[str], dst: str, force: bool = False) -> DataFrame:
    """The listed files that ``dst`` does not hold in this size and time; all of them under ``force``."""
    files = listed_files(spark, paths)
    return files if force else files.join(load_history(spark, dst), ["file", "size", "modified"], "left_anti")


def run_load(
    spark: SparkSession, dst: str, paths: Sequence[str], scan: Callable[[list[str]], DataFrame],
    on_error: str = "continue", force: bool = False,
) -> LoadResult:
    """Load the pending files of ``paths`` into ``dst``.

    ``scan`` reads files into rows with ``period_folder``, ``file`` and ``reason``, which is
    NULL for rows that fit. ``continue`` keeps the others aside, ``abort`` fails at the first.
    """
    if on_error not in ("continue", "abort"):
        raise ValueError(f"on_error is 'continue' or 'abort', not {on_error!r}")
    # The list of the new files, as any scan of them holds it on the driver.
    taken = pending_files(spark, paths, dst, force).collect()
    if not taken:
        return LoadResult(None, 0, 0, 0, 0)
    load_id = f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rows, fits = scan([f["path"] for f in taken]), F.col("reason").isNull()
    if on_error == "abort":
        rows = rows.filter(F.when(fits, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("refused row in "), "file", F.lit(": "), "reason")).cast("boolean")))
    seen = Observation()
    observed = rows.observe(
        seen, F.count("*").alias("rows_read"), F.count_if(fits).alias("rows_kept"))
    (
        observed.withColumn("load_id", F.lit(load_id)).withColumn("refused", ~fits)
        .write.mode("append").partitionBy("load_id", "refused", "period_folder").parquet(f"{dst}/rows")
    )
    noted = [(f["file"], f["size"], f["modified"], load_id) for f in taken]
    spark.createDataFrame(noted, HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{dst}/history")
    read, kept = seen.get["rows_read"], seen.get["rows_kept"]
    return LoadResult(load_id, len(taken), read, kept, read - kept)


def _current(spark: SparkSession, dst: str, refused: bool | None) -> DataFrame:
    """Rows of the last load of each file; loads that were not noted do not show."""
    rows = spark.read.parquet(f"{dst}/rows").withColumn("period_folder", F.col("period_folder").cast("string"))
    if refused is not None:
        rows = rows.filter(F.col("refused") == refused)
    history = load_history(spark, dst).select("load_id", "file")
    last = history.groupBy("file").agg(F.max("load_id").alias("last"))
    replaced = history.join(last, "file").filter("load_id < last").select("load_id", "file").distinct()
    # The folders of loads that were not noted are left out unread; few files are loaded again.
    noted = rows.join(history.select("load_id").distinct(), "load_id", "left_semi")
    return noted.join(replaced, ["load_id", "file"], "left_anti")


def loaded_rows(spark: SparkSession, dst: str) -> DataFrame:
    """The rows that fit, of the last load of each file, with their ``period_folder``."""
    return _current(spark, dst, refused=False).drop("load_id", "file", "refused", "reason")


def refused_rows(spark: SparkSession, dst: str) -> DataFrame:
    """The refused rows, of the last load of each file, with ``file`` and ``reason``."""
    return _current(spark, dst, refused=True).drop("load_id", "refused")


def load_report(spark: SparkSession, dst: str, by: Sequence[str] = ("file",)) -> DataFrame:
    """Rows read, kept and refused and the first reason, per file or any of file, period and load.

    A file without rows has no row here but one in the history.
    """
    rows = _current(spark, dst, refused=None)
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows_read"), F.count_if(~F.col("refused")).alias("rows_kept"),
        F.count_if("refused").alias("rows_refused"), F.min("reason").alias("first_reason"),
    ).withColumn("status", F.when(F.col("rows_refused") == 0, "LOADED")
                 .when(F.col("rows_kept") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))


def scan_raw(spark: SparkSession, table: str, paths: list[str], types: bool = True) -> DataFrame:
    """All-string rows of a raw table's files with their file and the reason to refuse them."""
    return raw_csv(spark.read, table).csv(paths).select(
        *RAW_COLUMNS[table], F.col("_metadata.file_path").alias("file")
    ).select("*", period_of(F.col("file")).alias("period_folder"), misfit(table, types).alias("reason"))


def load_raw(
    spark: SparkSession, root: str, table: str, dst: str, periods: Sequence[str] | None = None,
    on_error: str = "continue", force: bool = False, unpacked: bool = False, types: bool = True,
) -> LoadResult:
    """Load the files of a raw table that ``dst`` does not hold yet.

    A row is refused if a required column is missing or, with ``types``, a text does not
    fit its type. ``loaded_rows`` has the raw columns and the period.
    """
    paths = raw_paths(root, table, periods, unpacked)
    return run_load(spark, dst, paths, lambda files: scan_raw(spark, table, files, types), on_error, force)


def scan_variants(spark: SparkSession, paths: list[str], form: str = "lines") -> DataFrame:
    """Documents as VARIANT in ``doc``; a text that is no JSON object is refused, with its ``value``."""
    text = F.make_valid_utf8("value")
    rows = spark.read.text(paths, wholetext=form == "files").filter(F.trim("value") != "").select(
        text.alias("value"), F.col("_metadata.file_path").alias("file"))
    parsed = rows.select("*", F.try_parse_json("value").alias("doc"))
    reason = F.when(F.col("doc").isNull(), "no JSON").when(
        ~F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT")), "no JSON object")
    return parsed.select("*", period_of(F.col("file")).alias("period_folder"), reason.alias("reason")).select(
        F.when(F.col("reason").isNull(), F.col("doc")).alias("doc"),
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"),
        "file", "period_folder", "reason")


def load_documents(
    spark: SparkSession, root: str, dst: str, periods: Sequence[str] | None = None,
    form: str = "lines", on_error: str = "continue", force: bool = False,
) -> LoadResult:
    """Land the documents under ``root`` in one VARIANT column, whatever fields they have."""
    paths = document_paths(root, periods, form)
    return run_load(spark, dst, paths, lambda files: scan_variants(spark, files, form), on_error, force)


def landed_documents(spark: SparkSession, dst: str) -> DataFrame:
    """``doc`` (VARIANT) and ``period_folder`` of the landed documents."""
    return loaded_rows(spark, dst).select("period_folder", "doc")
