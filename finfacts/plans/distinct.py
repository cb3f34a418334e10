"""Load counts that follow a new period: exact distinct counts out of bitmaps that merge.

Every symbol has a position in a dictionary that only grows. A period leaves, for each
table, its rows and a bitmap of the positions of its symbols; the union of bitmaps
counts the symbols of all periods, whatever they share.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.operators.numbering import consecutive
from finfacts.sources.sinks import save_model

_SYMBOLS = "symbol string, position bigint"


def _dictionary(spark: SparkSession, store: str) -> DataFrame:
    try:
        return spark.read.schema(_SYMBOLS).parquet(f"{store}/symbols")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SYMBOLS)


def add_counts(tables: Mapping[str, DataFrame], store: str, period: str) -> None:
    """Take the rows of one period into ``store``: tables with a ``symbol``, by the title of their count.

    A period loaded again replaces itself. One load at a time may write a store.
    """
    spark = next(iter(tables.values())).sparkSession
    counted = None
    for title, df in tables.items():
        own = df.groupBy("symbol").agg(F.count("*").alias("n")).withColumn("check_type", F.lit(title))
        counted = own if counted is None else counted.unionByName(own)
    save_model(counted.withColumn("period_folder", F.lit(period)), f"{store}/counts", partition_by=["period_folder"])
    counts = spark.read.parquet(f"{store}/counts").filter(F.col("period_folder") == period)
    known = _dictionary(spark, store)
    first = known.agg(F.coalesce(F.max("position") + 1, F.lit(0).cast("long"))).first()[0]
    new = counts.select("symbol").dropna().distinct().join(known, "symbol", "left_anti")
    consecutive(new, ["symbol"], "position", first).select("symbol", "position") \
        .write.mode("append").parquet(f"{store}/symbols")
    placed = counts.join(_dictionary(spark, store), "symbol")
    bitmaps = placed.groupBy("check_type", F.bitmap_bucket_number("position").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap"))
    totals = counts.groupBy("check_type").agg(F.sum("n").alias("record_count"))
    for name, rows in (("bitmaps", bitmaps), ("totals", totals)):
        save_model(rows.withColumn("period_folder", F.lit(period)), f"{store}/{name}",
                   partition_by=["period_folder"])


def load_counts_of_periods(spark: SparkSession, store: str) -> DataFrame:
    """Records and distinct symbols of each table over all periods, out of totals and bitmaps only."""
    merged = spark.read.parquet(f"{store}/bitmaps").groupBy("check_type", "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    symbols = merged.groupBy("check_type").agg(F.sum(F.bitmap_count("bitmap")).alias("unique_symbols"))
    totals = spark.read.parquet(f"{store}/totals").groupBy("check_type").agg(
        F.sum("record_count").alias("record_count"))
    return totals.join(symbols, "check_type", "left").select(
        "check_type", "record_count", F.coalesce("unique_symbols", F.lit(0).cast("long")).alias("unique_symbols"))
