"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finfacts.llm.common import stored


def _stars(links: DataFrame) -> DataFrame:
    """One round: larger neighbours go to the smallest of a neighbourhood, then smaller ones too.

    Neighbourhoods are reduced to their minimum before they move, never listed.
    """
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and its ``component``, the smallest node it reaches, for all nodes with links.

    ``links`` has two bigint columns; direction, repeats and self-links do not matter.
    Every round is stored in the shared folder; rounds end when the links stay the same.
    """
    a, b = links.columns
    current = stored(links.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).filter("a <> b").distinct())
    state = None
    while True:
        mark = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if mark["n"] == 0 or mark == state:
            break
        state = mark
        current = stored(_stars(current))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select("b", "b").distinct()
    )
