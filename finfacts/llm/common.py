"""Helpers of the operators: stored intermediate tables, content keys, column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from finfacts.sources.sinks import scratch_folder

# What counts as white space between words, and its pattern.
SPACES = b" \t\n\r\x0b\x0c"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read of that table, nothing before it.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def content_key(*columns: str | Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that stand for the content of a row; equal rows share them.

    A hash passes over a null, so the places of nulls are hashed too.
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    nulls = [v.isNull() for v in values]
    return (F.xxhash64(*values, *nulls).alias("k1"),
            F.xxhash64(F.lit(7), *values, *nulls).alias("k2"))


def nested(df: DataFrame, *more: Column) -> DataFrame:
    """All columns as one struct ``row``, so that no helper column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)


def unnested(df: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    """The columns of ``row`` again, and ``more``, which replace columns of the same name."""
    kept = [F.col("row").getField(c).alias(c) for c in columns if c not in more]
    return df.select(*kept, *more)


def shape(df: DataFrame, columns: Sequence[str], more: str = "") -> StructType:
    """The schema of some columns of ``df`` followed by further ones."""
    return StructType([df.schema[c] for c in columns] + (StructType.fromDDL(more).fields if more else []))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


Batches = Iterator[pa.RecordBatch]
Mapper = Callable[[Batches], Batches]


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batch(**columns: tuple[Sequence, pa.DataType]) -> pa.RecordBatch:
    """A record batch of Python or numpy values with their types."""
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in columns.values()], names=list(columns)
    )
