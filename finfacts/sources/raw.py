"""Tab-separated raw tables, the ticker list and the typed projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from finfacts.functions import parse_period
from finfacts.schema import (
    RAW_COLUMNS, REQUIRED_COLUMNS, TICKER_SCHEMA, TYPED_COLUMNS, raw_schema,
)

PERIOD_PATTERN = r"(\d{4}q[1-4])"


def period_of(path: Column) -> Column:
    """Period key within a file path; NULL if there is none."""
    found = F.regexp_extract(path, PERIOD_PATTERN, 1)
    return F.when(found != "", found)


def require(df: DataFrame, valid: Column, on_error: str, message: str) -> DataFrame:
    """Error policy of a load: fail at the first invalid row, or skip invalid rows."""
    if on_error == "skip":
        return df.filter(valid)
    if on_error != "abort":
        raise ValueError(f"on_error is 'abort' or 'skip', not {on_error!r}")
    stop = F.raise_error(F.lit(message)).cast("boolean")
    return df.filter(F.when(F.coalesce(valid, F.lit(False)), F.lit(True)).otherwise(stop))


def raw_paths(root: str, table: str, periods: Sequence[str] | None, unpacked: bool) -> list[str]:
    """Paths of a table's files; only the wanted period folders are listed."""
    folder = "period_folder={}/member={}.txt" if unpacked else "{}/{}.txt"
    return [f"{root.rstrip('/')}/{folder.format(p, table)}" for p in (periods or ["*"])]


def raw_csv(source: DataFrameReader | DataStreamReader, table: str) -> DataFrameReader | DataStreamReader:
    """A batch or stream reader set up for the files of a raw table."""
    return (
        source.schema(raw_schema(table))
        .option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
    )


def read_raw(
    spark: SparkSession, root: str, table: str, periods: Sequence[str] | None = None,
    on_error: str = "abort", unpacked: bool = False,
) -> DataFrame:
    """All-string rows of ``{root}/{period}/{table}.txt`` with their ``period_folder``.

    The header line is skipped, fields may be quoted and are trimmed, and short
    or long rows are padded or cut. A row without a required column is an error.
    ``unpacked`` reads the folders written by ``unpack_archives``. Files are split
    and read in parallel.
    """
    rows = raw_csv(spark.read, table).csv(raw_paths(root, table, periods, unpacked))
    named = rows.select(
        *RAW_COLUMNS[table], period_of(F.col("_metadata.file_path")).alias("period_folder")
    )
    required = REQUIRED_COLUMNS[table]
    if not required:
        return named
    valid = F.lit(True)
    for column in required:
        valid = valid & F.col(column).isNotNull()
    return require(named, valid, on_error, f"{table}: a required column is missing")


def read_tables(
    spark: SparkSession, root: str, periods: Sequence[str] | None = None,
    on_error: str = "abort", unpacked: bool = False,
) -> dict[str, DataFrame]:
    """The four raw tables."""
    return {t: read_raw(spark, root, t, periods, on_error, unpacked) for t in RAW_COLUMNS}


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """``symbol, cik`` of a headerless list with ``ord``, the position in the file."""
    rows = (
        spark.read.schema(TICKER_SCHEMA).option("sep", "\t").csv(path)
        .select("symbol", "cik", F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"))
    )
    return rows.withColumn("cik", F.trim("cik"))


def _typed(column: str, kind: str | None) -> Column:
    text = F.col(column)
    if kind is None:
        return text
    if kind == "date":
        return F.coalesce(parse_period(text), text.try_cast("date"))
    return text.try_cast(kind)


def misfit(table: str, types: bool = True) -> Column:
    """Why a raw row cannot be loaded: the first required column it lacks, or text of the wrong type; else NULL."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in REQUIRED_COLUMNS[table]]
    if types:
        reasons += [
            F.when(F.col(c).isNotNull() & _typed(c, kind).isNull(), F.lit(f"{c} is no {kind}"))
            for c, kind in TYPED_COLUMNS[table].items()
        ]
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def typed(df: DataFrame, table: str, on_error: str = "null") -> DataFrame:
    """Typed form of an all-string table.

    A text that does not fit its type becomes NULL, or is an error under
    ``abort``, or removes its row under ``skip``.
    """
    kinds = TYPED_COLUMNS[table]
    if on_error != "null" and kinds:
        fits = F.lit(True)
        for column, kind in kinds.items():
            fits = fits & (F.col(column).isNull() | _typed(column, kind).isNotNull())
        df = require(df, fits, on_error, f"{table}: a value does not fit its type")
    extra = [c for c in df.columns if c not in RAW_COLUMNS[table]]
    return df.select(
        *[_typed(c, kinds.get(c)).alias(c) for c in RAW_COLUMNS[table]], *extra
    )


def store_tables(tables: dict[str, DataFrame], root: str, files: int | None = None) -> None:
    """Store raw tables as Parquet, one folder each, by period if they have one.

    ``num`` and ``pre`` are sorted by tag within their files, so a query for some
    tags skips the row groups of all others. ``files`` sets how many tasks write.
    """
    for name, df in tables.items():
        period = ["period_folder"] if "period_folder" in df.columns else []
        if files is not None:
            df = df.repartition(files)
        elif period:
            df = df.hint("rebalance", *period)
        if name in ("num", "pre"):
            df = df.sortWithinPartitions(*period, "tag", "adsh")
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if period else "static")
        (writer.partitionBy(*period) if period else writer).parquet(f"{root}/{name}")


def stored_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Raw tables stored by ``store_tables``."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}
