"""Consecutive numbers for rows, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from finfacts.sources.sinks import scratch_folder


def consecutive(df: DataFrame, order: Sequence[str], name: str, first: int = 0) -> DataFrame:
    """``df`` with numbers from ``first`` on in the order of columns (NULLs first); ties in any order.

    The rows are sorted by ranges and stored in the scratch folder; a part's numbers
    follow those of the parts before, of which only the sizes meet in one task.
    """
    spark = df.sparkSession
    path, n = scratch_folder(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    # The upper bits of the id are the part, the lower ones the place in it.
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + F.lit(first)
    # One row for each part.
    return rows.join(F.broadcast(before), "_part").withColumn(name, number).drop("_at", "_part", "_before")
