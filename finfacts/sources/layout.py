"""Tables laid out by several keys at once, so that a filter on any of them skips most of the table.

The ranks of a row's keys are interleaved bit by bit, and rows are stored in the order of
the result. Files, row groups and pages then cover a small range of every key, where a
sort by one key leaves the full range of the others in each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows that the ranges are cut from, about, and bits of a rank.
SAMPLE = 1 << 16
BITS = 8


def key_bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> list[list]:
    """Per key at most ``2 ** bits - 1`` ascending values that cut its rows into ranges of about equal size.

    They come from about ``sample`` rows, all that reaches the driver, whatever the size of
    ``df``; they decide about places only. A value that many rows share is a bound several times,
    so that ranks of few values use all bits too.
    """
    total = df.count()
    named = df.select(*[F.col(f"`{k}`") for k in keys])
    rows = named.sample(min(1.0, sample / max(total, 1)), seed=42).collect()
    bounds, ranges = [], 1 << bits
    for i in range(len(keys)):
        values = sorted(row[i] for row in rows if row[i] is not None)
        bounds.append([values[len(values) * r // ranges] for r in range(1, ranges)] if values else [])
    return bounds


def range_rank(value: Column, bounds: Sequence, bits: int = BITS) -> Column:
    """How many of the ascending ``bounds`` are not above ``value``, by binary search; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    cuts, steps = F.array(*map(F.lit, bounds)), F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    # Beyond the last bound there is NULL, which no value reaches.
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at)
    )


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several ranks as one number, from the highest bit of each to the lowest."""
    if len(ranks) * bits > 63:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit into one number")
    out, width = F.lit(0).cast("long"), len(ranks)
    for b in range(bits):
        for i, rank in enumerate(ranks):
            bit = F.shiftright(rank, b).bitwiseAND(1).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * width + width - 1 - i))
    return out


def store_by_keys(
    df: DataFrame, path: str, keys: Sequence[str] = ("tag", "adsh"), files: int | None = None,
    partition_by: Sequence[str] = (), bits: int = BITS,
) -> None:
    """Store ``df`` as Parquet under ``path`` in the interleaved order of ``keys``.

    ``df`` is read twice, for the ranges and for the rows, so it should be a stored table.
    Rows go to ``files`` tasks, by default the session's number of shuffle partitions, by ranges
    of ``partition_by``, the interleaved ranks, the keys and a hash of the row, so a value that
    a third of the rows share is spread. NULL keys come first; rows and columns stay as they are.
    """
    bounds = key_bounds(df, keys, bits)
    row = [F.col(f"`{c}`") for c in df.columns]
    ranks = [range_rank(F.col(f"`{k}`"), cuts, bits).alias(f"rank{i}")
             for i, (k, cuts) in enumerate(zip(keys, bounds))]
    ranked = df.select(F.struct(*row).alias("row"), F.xxhash64(*row).alias("tie"), *ranks)
    placed = ranked.select("row", "tie", interleaved([F.col(f"rank{i}") for i in range(len(keys))], bits).alias("z"))
    field = lambda c: F.col("row").getField(c)
    order = [*map(field, partition_by), F.col("z"), *map(field, keys), F.col("tie")]
    tasks = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order) \
        .select(*[field(c).alias(c) for c in df.columns])
    writer = laid.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if partition_by else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def files_hit(spark: SparkSession, path: str, where: str) -> DataFrame:
    """How narrow a layout is for a filter: ``files`` of the table, and ``files_hit``, those with fitting rows."""
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max(F.expr(where).cast("int")).alias("hit"))
    return rows.agg(F.count("*").alias("files"), F.coalesce(F.sum("hit"), F.lit(0)).alias("files_hit"))
