"""Staged files per period, and the periods still to be loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.schema import FIRST_YEAR
from finfacts.sources.raw import period_of


def staged_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files, bytes and first archive of every period under ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "length").withColumn("period_folder", period_of(F.col("path")))
    )
    return files.groupBy("period_folder").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"),
        F.min(F.when(F.lower("path").endswith(".zip"), F.col("path"))).alias("archive"),
    )


def is_staged(manifest: DataFrame, period: str) -> DataFrame:
    """The manifest row of one period: no row means that nothing is staged."""
    return manifest.filter(F.col("period_folder") == period)


def quarters(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Every quarter of the years ``first`` to ``last``."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return years.select("year", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("quarter")).select(
        "year", F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("quarter"),
        F.concat(
            F.col("year").cast("string"), F.lit("q"), F.col("quarter").cast("string")
        ).alias("period_folder"),
    )


def missing_periods(
    spark: SparkSession, manifest: DataFrame, last: int, first: int = FIRST_YEAR
) -> DataFrame:
    """Quarters of the calendar that the manifest does not hold."""
    present = manifest.select("period_folder").distinct()
    return quarters(spark, first, last).join(present, "period_folder", "left_anti")
