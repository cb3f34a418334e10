"""Incremental staging statements over arriving files of reported values."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from finfacts.plans.statements import Tables, staging
from finfacts.schema import RAW_COLUMNS
from finfacts.sources.raw import raw_csv, raw_paths
from finfacts.sources.sinks import shuffles_freed

_STORE = "spark.sql.streaming.stateStore."
# A session that names a provider of its own keeps it, with its settings.
STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each batch adds the rows that are new to the checkpoint, not all files of the state.
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
    # For all partitions of the state on an executor together.
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.maxMemoryUsageMB": "256",
    # Repeats are looked up key by key; a count of all keys would be read before each write.
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams begun inside keep their state in RocksDB, of which a bounded part is in memory.

    A checkpoint that was begun with another provider goes on with that one.
    """
    own = {} if spark.conf.get(f"{_STORE}providerClass", None) else STATE
    before = {key: spark.conf.get(key, None) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def value_stream(
    spark: SparkSession, src: str, unpacked: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """The rows of ``num`` of all period folders under ``src``, as their files arrive."""
    reader = raw_csv(spark.readStream, "num")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(raw_paths(src, "num", None, unpacked)[0]).select(*RAW_COLUMNS["num"])


def ingest_statements(
    spark: SparkSession, src: str, dictionaries: Tables, dst: str, checkpoint: str, *statements: str,
    unpacked: bool = False, files_per_batch: int | None = None,
) -> None:
    """Add the staging rows of the value files that arrived since the last run to ``dst``.

    ``dictionaries`` holds ``sub`` and ``tag`` as they are now, so load them before the values
    that need them. Staging rows are distinct over all batches: their keys are kept in the
    state under ``checkpoint``, which grows with the distinct rows and lies in RocksDB on the
    disks of the executors. Each file is read once, whichever run was cut short.
    """
    tables = {"num": value_stream(spark, src, unpacked, files_per_batch), **dictionaries}
    with state_on_disk(spark), shuffles_freed(spark):
        query = (
            staging(tables, *statements).writeStream.format("parquet").outputMode("append")
            .option("path", dst).option("checkpointLocation", checkpoint).partitionBy("source_file")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()


def ingested_statements(spark: SparkSession, dst: str) -> DataFrame:
    """The staging rows under ``dst``, as far as their batches are complete."""
    rows = spark.read.parquet(dst)
    return rows.withColumn("source_file", F.col("source_file").cast("string"))
